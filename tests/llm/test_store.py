"""What a stored result leaves on the executors' disks."""

import os
import tempfile
import time
from pathlib import Path

from orderloom.llm import near_copies
from orderloom.llm.common import store
from orderloom.llm.queries import find_package
from pyspark.sql import functions as F


def shuffle_files():
    root = os.environ.get("SPARK_LOCAL_DIRS") or tempfile.gettempdir()
    return set(Path(root).glob("**/blockmgr-*/*/shuffle_*.data"))


def left_since(before, most):
    """Files go in the background: wait for it a little."""
    for _ in range(50):
        left = shuffle_files() - before
        if len(left) <= most:
            break
        time.sleep(0.1)
    return len(left)


def test_a_stored_result_leaves_no_shuffle_files(spark):
    held = [spark.range(1000).groupBy(F.col("id") % 7).count() for _ in range(3)]
    before = shuffle_files()
    out = [store(df, "test") for df in held]
    assert left_since(before, 0) == 0
    assert [df.count() for df in out] == [7, 7, 7]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"



def test_pairs_verified_in_passes_are_those_of_one_pass(spark, monkeypatch):
    find_package(spark)
    texts = [" ".join(f"w{j + (i % 4) * 100}" for j in range(30 + i % 2)) for i in range(12)]
    rows = store(spark.createDataFrame(list(enumerate(texts)), "_row long, _text string"), "test")
    every = [(a, b) for a in range(12) for b in range(a + 1, 12)]
    pairs = store(spark.createDataFrame(every, "a long, b long"), "test")
    monkeypatch.setattr(near_copies, "PAIRS_PER_PASS", 30)
    found = sorted(map(tuple, near_copies.verified_in_passes(pairs, rows).collect()))
    assert found == [(a, b) for a, b in every if a % 4 == b % 4]
