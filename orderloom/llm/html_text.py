"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by where they stand (the
elements around them, their classes and ids, the length of the run), tags score negative by kind; one
linear scan finds the contiguous region with the highest total. Blocks of the
region whose own words score clearly negative (an advert between two paragraphs)
are left out.

All weights come from labelled pages: a logistic model over the features of the
elements around each run of text, and log-odds for tags. Labelled are the pages
below, and a bounded sample of the table's own pages whose author marks one
``article``.
"""

from __future__ import annotations

import html
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.llm.common import sample, text_of

# --- fixed values: element names of HTML --------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = "script|style|noscript|template|iframe|svg|math|textarea|object"
#: Elements that end at the next one of the same kind, or where their parent ends.
CLOSED_BY_NEXT = frozenset("p li dd dt tr td th option".split())
#: Elements inside which the next one of the same kind is another list's.
LISTS = ("ul", "ol", "table", "dl", "menu")
# --- end of fixed values --------------------------------------------------------

#: What a tag holds: a quote opens a value only after an equals sign, elsewhere it is a character.
_INSIDE = r"(?:[^<>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+"
_ITEM = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b{_INSIDE}>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([A-Za-z][^\s/>]*)({_INSIDE})(?:>|\Z|(?=<))"
    r"|([^<]+|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORST, BEST = -3.0, 3.0
#: Score a word from which a block inside the region stays.
LEAST = 0.0


@dataclass(frozen=True)
class Model:
    bias: float
    words: dict[str, float]
    tags: dict[str, float]
    other_tag: float


@dataclass(eq=False, slots=True)
class Around:
    """Features of a run of text or an open element, and the element around it: nesting costs
    one step each."""

    own: tuple[str, ...]
    outer: Around | None
    score: float | None = None  #: of all features up to here, once asked for

    def features(self) -> list[str]:
        found, around = [], self
        while around is not None:
            found += around.own
            around = around.outer
        return found


@dataclass
class Item:
    """A run of text inside one block, or a tag (``text`` is None then)."""

    text: str | None
    tag: str
    around: Around | None
    block: int
    at: int


def features_of(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    if attributes:
        for groups in _NAMED.findall(attributes):
            found += [f".{part.lower()}" for part in _PART.findall("".join(groups))]
    return tuple(found)


def _size(text: str) -> str:
    """Feature of a run's length: prose comes in longer runs than menus do."""
    words = text.count(" ") + 1
    return "~" + str(next((n for n in (25, 12, 6, 3) if words >= n), 1))


def items_of(page: str) -> Iterator[Item]:
    """Words and tags in page order; scripts, styles and comments are left out."""
    stack: list[tuple[str, Around]] = []
    places: dict[str, list[int]] = {}  # of each open element's name on the stack

    def close(first: int) -> None:
        while len(stack) > first:
            places[stack.pop()[0]].pop()

    block = 0
    for m in _ITEM.finditer(page):
        raw_tag, slash, tag, attributes, text = m.groups()
        if text is not None:
            outer = stack[-1][1] if stack else None
            yield Item(text, "", Around((_size(text),), outer), block, m.start())
            continue
        if raw_tag or tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            block += 1
        if slash:
            if places.get(tag):
                close(places[tag][-1])
        elif tag not in VOID:
            if tag in BLOCK:
                if places.get("p"):
                    close(places["p"][0])
                elif tag in CLOSED_BY_NEXT and places.get(tag):
                    last = places[tag][-1]
                    if not any(places.get(x) and places[x][-1] > last for x in LISTS):
                        close(last)
            places.setdefault(tag, []).append(len(stack))
            outer = stack[-1][1] if stack else None
            stack.append((tag, Around(features_of(tag, attributes), outer)))
        yield Item(None, slash + tag, None, block, m.start())


def word_score(model: Model, around: Around) -> float:
    """Score of a word of a run of text, from the run and all elements around it."""
    path = []
    while around is not None and around.score is None:
        path.append(around)
        around = around.outer
    total = model.bias if around is None else around.score
    for around in reversed(path):
        total = around.score = total + sum(model.words.get(f, 0.0) for f in around.own)
    return min(BEST, max(WORST, total))


def extract(page: str | None, model: Model) -> str:
    """The page's main text: blocks joined by an empty line. Empty if no region scores above 0."""
    items = list(items_of(page or ""))
    best = total = 0.0
    start, region = 0, (0, 0)
    scores = []
    for i, item in enumerate(items):
        if item.text is None:
            score = model.tags.get(item.tag, model.other_tag)
        else:
            score = word_score(model, item.around) * len(item.text.split())
        scores.append(score)
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
    blocks: dict[int, list[str]] = {}
    worth, words = Counter(), Counter()
    for item, score in zip(items[slice(*region)], scores[slice(*region)], strict=True):
        if item.text is not None:
            blocks.setdefault(item.block, []).append(item.text)
            worth[item.block] += score
            words[item.block] += len(item.text.split())
        elif item.tag in ("br", "/td", "/th"):
            blocks.setdefault(item.block, []).append(" ")
    texts = [" ".join(html.unescape("".join(b)).split()) for k, b in blocks.items() if worth[k] >= LEAST * words[k]]
    return "\n\n".join(t for t in texts if t)


def fit(labelled: Iterable[tuple[str, list[tuple[int, int]]]], steps: int = 400) -> Model:
    """Weights from pages and the character spans of their main text."""
    runs, inside, weights = [], [], []
    in_tags, out_tags = Counter(), Counter()
    for page, spans in labelled:
        for item in items_of(page):
            good = any(a <= item.at < b for a, b in spans)
            if item.text is None:
                (in_tags if good else out_tags)[item.tag] += 1
            elif n := len(item.text.split()):
                runs.append(item.around.features())
                inside.append(good)
                weights.append(min(n, 20))
    names = {f: i for i, f in enumerate(sorted({f for r in runs for f in r}))}
    x = np.zeros((len(runs), len(names)))
    for i, around in enumerate(runs):
        for f in around:
            x[i, names[f]] += 1
    y, w = np.array(inside, float), np.array(weights, float)
    for side in (0, 1):  # either side weighs the same
        w[y == side] /= max(w[y == side].sum(), 1)
    beta, bias = np.zeros(len(names)), 0.0
    first = second = np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ beta + bias, -30, 30)))
        grad = np.append(x.T @ (w * (y - p)) - 0.01 * beta, (w * (y - p)).sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        beta, bias = beta + move[:-1], bias + float(move[-1])
    tags = {}
    for tag in in_tags | out_tags:
        odds = math.log((in_tags[tag] + 0.5) / (out_tags[tag] + 0.5))
        tags[tag] = min(-0.1, max(WORST, odds - 1.0))
    return Model(bias, dict(zip(names, beta.tolist(), strict=True)), tags, -0.3)


_ARTICLE = re.compile(r"<article\b[^>]*>(.*?)</article\s*>", re.S | re.I)


def labelled_by_author(page: str | None) -> tuple[str, list[tuple[int, int]]] | None:
    """A page with exactly one ``article``, and where that is."""
    found = [m.span(1) for m in _ARTICLE.finditer(page or "")]
    return (page, found) if len(found) == 1 else None


def marked_pages() -> tuple[str, ...]:
    """PAGES, and pages put together from FRAMES, PARTS and PROSE in turn."""
    out = list(PAGES)
    for i in range(3 * len(FRAMES)):
        prose = [PROSE[(i + k) % len(PROSE)] for k in range(5)]
        side = [PARTS[(7 * i + k) % len(PARTS)] for k in range(7)]
        tag = FRAMES[i % len(FRAMES)]
        end = f"</{tag.split()[0]}>"
        inner = "".join(f"<p>{x}</p>" for x in prose[1:3])
        lists = f"<ul><li>{prose[3]}</li><li>{prose[4]}</li></ul>" if i % 2 else f"<p>{prose[3]}</p>"
        out.append(
            f"<html><head><title>{prose[0][:30]}</title></head><body>{side[0]}{side[1]}{side[2]}<{tag}>"
            f"{{{{<h{1 + i % 2}>{prose[0][:40]}</h{1 + i % 2}>{inner}}}}}{side[3]}"
            f"{{{{{lists}<p>{prose[4]}</p>}}}}{end}{side[4]}{side[5]}{side[6]}</body></html>"
        )
    return tuple(out)


def labelled_by_hand() -> list[tuple[str, list[tuple[int, int]]]]:
    """The pages below; ``{{`` and ``}}`` stand around main text."""
    out = []
    for marked in marked_pages():
        page, spans, opened = "", [], 0
        for part in re.split(r"(\{\{|\}\})", marked):
            if part == "{{":
                opened = len(page)
            elif part == "}}":
                spans.append((opened, len(page)))
            else:
                page += part
        out.append((page, spans))
    return out


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most_pages: int = 300) -> Model:
    """Fit on the pages below and on at most ``most_pages`` of the table that mark one
    article, from four times as many pages chosen by the id's hash."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
    chosen = sample(rows, "_id", 4 * most_pages).where(F.col("_html").contains("</article"))
    marked = (labelled_by_author(row._html) for row in chosen.toLocalIterator())
    found = list(itertools.islice(filter(None, marked), most_pages))
    by_hand = labelled_by_hand()
    return fit(found + by_hand * max(1, len(found) // (4 * len(by_hand))))


def main_text(
    pages: DataFrame, model: Model, id_col: str = "page_id", html_col: str = "html"
) -> DataFrame:
    """``pages`` without the html and with ``text``, one row per input row.

    NULL and empty pages, and pages without a region that scores above zero, have
    an empty text. A column of ``pages`` named ``text`` is replaced. Pages that
    break off are read to their end.
    """
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    schema = StructType([*(pages.schema[c] for c in kept), StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, model) for page in batch.column(len(kept)).to_pylist()]
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return pages.select(*kept, text_of(html_col).alias("_html")).mapInArrow(run, schema)


#: Labelled pages, written for this module.
PAGES = (
    '<html><head><title>Tides</title></head><body><header class="site-header"><a href="/">Coast Notes</a>'
    '<form class="search"><label>Search this site</label><button>Go</button></form></header>'
    '<nav class="main-menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">Archive</a></li></ul></nav>'
    '<div class="cookie-notice"><p>We use cookies to improve your visit. <a>Accept all</a></p></div>'
    '<main><div class="content">{{<h1>How tides are made</h1><p>The moon pulls the water on the near side '
    "more than the <a href='/earth'>solid earth</a>, and the earth more than the water behind it.</p>"
    "<p>Twice a day the shore turns through both bulges, and the sea rises and falls.</p>}}"
    '<div class="ad-box"><p>Buy warm boots today at half price.</p></div>'
    "{{<h2>Spring and neap</h2><p>When sun and moon stand in line their pulls add up, and the tides are "
    "at their highest.</p><ul><li>Spring tides follow new and full moon.</li><li>Neap tides follow the "
    'quarters.</li></ul>}}</div></main><aside class="sidebar"><h3>Popular posts</h3><ul><li><a>Ten beaches'
    '</a></li><li><a>Old maps</a></li></ul></aside><section class="comments" id="comments"><h3>2 comments</h3>'
    '<div class="comment"><p>Great read, thanks for posting this.</p></div><div class="comment"><p>I never '
    "understood neap tides until now, really helpful.</p></div></section>"
    '<footer class="site-footer"><p>Copyright Coast Notes. All rights reserved.</p></footer></body></html>',
    '<html><body><div id="top-banner">Subscribe to our newsletter and never miss a story</div>'
    '<div id="nav"><a>News</a> <a>Sport</a> <a>Weather</a></div><div class="breadcrumb"><a>Home</a> / <a>City'
    '</a></div><div class="post"><div class="entry">{{<h1>Old bridge opens again</h1><p>After three years '
    "of work the stone bridge over the river is open to walkers and carts.</p><blockquote>It looks as it "
    "did when I was young, said one of the first to cross.</blockquote><p>The town paid for the work with "
    'a small tax on mooring.</p>}}</div><div class="share-buttons"><a>Share</a><a>Tweet</a></div>'
    '<div class="related"><h3>Related stories</h3><ul><li><a>Ferry returns</a></li><li><a>Mill for sale</a>'
    '</li></ul></div></div><div class="widget newsletter"><form><p>Get the weekly letter in your inbox'
    '</p><input name="mail"></form></div><div id="footer">Imprint Contact Privacy policy Terms of use</div>',
    "<html><body><header><p>Daily Orchard, the paper for growers</p></header><nav><a>Start</a><a>Trees</a></nav>"
    '<div role="alert" class="notice"><p>This page will be offline on Sunday for maintenance.</p></div>'
    "<article>{{<h1>Pruning in winter</h1><p>Cut on a dry day, above a bud that faces outward, and never "
    "take more than a third of the crown.</p><table><tr><td>Apple</td><td>January</td></tr><tr><td>Pear</td>"
    "<td>February</td></tr></table><p>Clean the blade between trees so that canker does not spread.</p>}}"
    '<aside class="promo"><p>Our new book on grafting is in the shop.</p></aside>'
    "{{<p>Paint is not needed on small cuts.</p>}}</article>"
    '<div class="advertisement"><p>Ladders and saws, free delivery this week only.</p></div>'
    '<div id="disqus_thread"><ol class="comment-list"><li><p>My pear tree never recovered from this.</p></li>'
    "<li><p>Thank you, the tip about the blade helped.</p></li></ol><form id='reply'><p>Leave a reply below"
    "</p></form></div><footer><ul><li>About us</li><li>Jobs</li></ul></footer></body></html>",
)

#: Elements that hold main text, parts that aren't main text, and sentences.
FRAMES = (
    "article", "main", 'div class="content"', 'div id="main-content"', 'div class="post-body"',
    'div class="entry-content"', 'section class="article-body"', 'div class="story"', "div",
    'article class="post"', 'div role="main"', 'div class="page-text"',
)
PARTS = (
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>',
    '<header class="site-header"><a href="/">The Harbour Letter</a><p>News from the quay</p></header>',
    '<footer><p>Copyright by the makers, all rights reserved.</p><a>Imprint</a></footer>',
    '<aside class="sidebar"><h3>Most read</h3><ul><li><a>Storm at night</a></li></ul></aside>',
    '<div class="cookie-banner"><p>This site uses cookies, read how we use your data here.</p></div>',
    '<div class="ad"><p>Fresh paint for every boat, order before the end of the week.</p></div>',
    '<form class="search-form"><label>Search</label><input name="q"><button>Find it</button></form>',
    '<section class="comments"><h3>Comments</h3><div class="comment"><p>I was there and it was just as '
    "you say, what a night.</p></div></section>",
    '<div id="sidebar"><h4>Archive</h4><ul><li><a>March</a></li><li><a>April</a></li></ul></div>',
    '<div class="related-posts"><h3>Read next</h3><a>Nets mended by hand</a></div>',
    '<div class="notice"><p>The office is closed over the holidays, write to us instead.</p></div>',
    '<div class="footer"><p>Contact, terms of use and privacy policy of this site.</p></div>',
    '<div class="advert sponsored"><p>Sponsored: a better rope for less, see the whole range.</p></div>',
    '<div id="menu"><a>Start</a> <a>About</a> <a>Contact us</a></div>',
    '<div class="newsletter signup"><p>Get our letter every week, right to your inbox.</p></div>',
    '<div id="comments"><ol class="comment-list"><li><p>Thanks, I will try it with my own boat next '
    "spring.</p></li></ol></div>",
    '<div class="share social"><a>Share this</a><a>Send by mail</a></div>',
    '<div class="user-comments"><p class="comment-author">Ada</p><p class="comment-text">We tried this last '
    "year and would not do it again.</p></div>",
    '<div class="popup modal"><p>Wait, before you go, take a look at our best offers.</p></div>',
    '<header><nav class="navbar"><a>Map</a><a>Tickets</a></nav></header>',
)
PROSE = (
    "The pilot boat leaves at six, and on most days it is back before the market has opened its doors.",
    "Nobody in the village could say when the old light had last been lit, or by whom.",
    "Salt works into the grain of the wood and keeps it from rotting for a hundred years or more.",
    "In spring the river carries so much silt that the channel has to be dredged twice.",
    "She measured the depth with a weighted line, called out the number and wrote it down.",
    "Fog comes in from the north in the afternoon and stays until the wind turns.",
    "A good knot holds under load, comes apart by hand and leaves no kink in the rope.",
)
