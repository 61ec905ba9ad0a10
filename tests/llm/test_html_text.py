import itertools
import time

import pytest
from orderloom.llm import html_text
from orderloom.llm.queries import find_package


@pytest.fixture(scope="module")
def model():
    return html_text.fit(html_text.labelled_by_hand())


def want_of(marked):
    """The text between the marks, by splitting at tags that open or close a block."""
    import html
    import re

    out = []
    for part in re.findall(r"\{\{(.*?)\}\}", marked, re.S):
        part = re.sub(r"</t[dh]>", " ", part)
        out += re.split(r"</?(?:h\d|p|ul|li|blockquote|table|tr|td)\b[^>]*>", part)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in out)
    return "\n\n".join(t for t in texts if t)


def test_pages_left_out_of_training():
    """Pages of another layout: most of the main text, and hardly anything else."""
    for left_out in range(len(html_text.PAGES)):
        labelled = html_text.labelled_by_hand()
        page, _ = labelled.pop(left_out)
        got = set(html_text.extract(page, html_text.fit(labelled)).split())
        want = set(want_of(html_text.PAGES[left_out]).split())
        assert len(got & want) / len(want) > 0.5 and len(got & want) / len(got) > 0.95


def test_labelled_pages(model):
    pages = list(zip(html_text.marked_pages(), html_text.labelled_by_hand(), strict=True))
    exact = [html_text.extract(page, model) == want_of(marked) for marked, (page, _) in pages]
    assert sum(exact) / len(exact) > 0.85


def test_region_is_the_best_of_all(model):
    """The linear scan against every contiguous region."""
    for page, _ in html_text.labelled_by_hand():
        scores = []
        for item in html_text.items_of(page):
            if item.text is None:
                scores.append(model.tags.get(item.tag, model.other_tag))
            else:
                scores.append(html_text.word_score(model, item.around) * len(item.text.split()))
        sums = [0.0, *itertools.accumulate(scores)]
        best = max(b - a for i, a in enumerate(sums) for b in sums[i:])
        texts = html_text.extract(page, model)
        total = low = found = 0.0
        for s in scores:
            total = max(total, 0) + s
            found = max(found, total)
        assert found == pytest.approx(best) and texts and low == 0


def test_odd_pages(spark, model, no_docs):
    find_package(spark)
    prose = "the rest of this sentence is only there to make the paragraph long enough to count"
    body = f"<article><h1>Some heading</h1><p>{prose}</p><p>{{}} {prose}</p></article>"
    long_text = "word " * 200_000
    rows = [
        (1, "u", None, "old"),
        (2, "u", "", "old"),
        (3, "u", "<script>var a = '<p>no</p>'</script><!-- x -->", "old"),
        (4, None, body.format("a &amp; b &lt;c&gt;&#233; \n\t x<br>y <b>bold</b>er"), "old"),
        (5, "u", body.format("broken off &amp; here")[:-18], "old"),
        (6, "u", body.format(long_text), "old"),
        (6, "u", body.format(long_text), "old"),
        (7, "u", "<article><p>" + f"{prose}<p>{prose}<p title='a>b'>{prose}</article>", "old"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.main_text(frame, html_text.train(frame))
    assert got.columns == ["page_id", "url", "text"]
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[1] == texts[2] == texts[3] == ""
    head = f"Some heading\n\n{prose}\n\n"
    assert texts[4] == f"{head}a & b <c>é x y bolder {prose}"
    assert texts[5].startswith(f"{head}broken off & here the rest")
    assert texts[6] == f"{head}{long_text}{prose}" and texts[7] == "\n\n".join([prose] * 3)
    assert got.count() == len(rows)
    assert html_text.main_text(frame.limit(0), html_text.train(frame.limit(0))).count() == 0


def test_a_quote_opens_a_value_only_after_an_equals_sign():
    model = html_text.Model(1.0, {}, {}, -1.0)
    page = "<p>one two three</p><a title=don't href='x>y' b=\"it's\">four five six</a><p>it's seven eight</p><p 'odd\">nine ten eleven</p>"
    got = html_text.extract(page, model)
    assert got == "one two three\n\nfour five six\n\nit's seven eight\n\nnine ten eleven"
    open_quote = "<p>one two</p><a title='never closed>three</a><p>four</p>"
    assert html_text.extract(open_quote, model).startswith("one two")
    assert html_text.extract("<script a=b'c>x</script><p>text stays</p>", model) == "text stays"
    slow = "<div " + "a='b " * 20_000
    assert html_text.extract(slow, model) == ""


def test_deep_nesting_takes_time_in_proportion():
    model = html_text.fit(html_text.labelled_by_hand())
    for page in ("<div><b>some words here " * 20_000, "<ul><li>" * 20_000 + "a b c" + "</li></ul>" * 20_000):
        start = time.process_time()
        html_text.extract(page, model)
        assert time.process_time() - start < 2


def test_the_next_of_its_kind_closes_an_element():
    page = "<ul class=a><li>one<ul class=b><li>two</ul>three<li>four</ul>five<p>six<div>seven"
    found = {i.text: i.around.features()[1:] for i in html_text.items_of(page) if i.text}
    assert found == {
        "one": ["li", "ul", ".a"],
        "two": ["li", "ul", ".b", "li", "ul", ".a"],
        "three": ["li", "ul", ".a"],
        "four": ["li", "ul", ".a"],
        "five": [],
        "six": ["p"],
        "seven": ["div"],
    }
