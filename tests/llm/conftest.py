"""Documents with the cases every operator must define: NULLs, empty, long, ties, repeats."""

import random

import pytest
from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept long"


def make_docs(n: int = 120, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeétno", k=rng.randint(2, 8))) for _ in range(300)]
    out = []
    for i in range(n):
        lines = [" ".join(rng.choices(words, k=rng.randint(3, 12))) for _ in range(rng.randint(1, 9))]
        text = "\n".join(lines)
        out.append((i, text, "en", f"src{i % 3}", len(text), "x", 7))
    for i in range(n, n + 30):  # near and exact copies
        text = out[i % 10][1]
        text = text if i % 3 else text.replace(" ", "  ", 1)
        text = text if i % 2 else text + " tail"
        out.append((i, text, None, "src0", None, None, None))
    long_text = " ".join(rng.choices(words, k=30_000))
    odd = [None, "", " \t\n\x0b\f\r ", "one", "One two", " nbsp wide ", long_text, "A\n\nB\n"]
    for i, text in enumerate(odd * 2, start=n + 30):
        out.append((i, text, None, None, None, None, None))
    out += [out[3], out[3], (None, "no id", None, None, None, None, None)]
    return out


@pytest.fixture(scope="session")
def doc_rows():
    return make_docs()


@pytest.fixture
def docs(spark: SparkSession, doc_rows):
    from orderloom.llm.queries import find_package

    find_package(spark)
    return spark.createDataFrame(doc_rows, SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark: SparkSession):
    from orderloom.llm.queries import find_package

    find_package(spark)
    return spark.createDataFrame([], SCHEMA)
