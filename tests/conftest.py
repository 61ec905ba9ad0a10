import sys
import tempfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("orderloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.catalogImplementation", "in-memory")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="orderloom-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BASE = datetime(2024, 3, 1)


def at(seconds: float) -> datetime:
    return BASE + timedelta(seconds=seconds)


def rows(df):
    return [tuple(r) for r in df.collect()]


def event(
    order="o1",
    kind="LINE_ITEM_STATUS_CHANGED",
    ts=0,
    status="FULFILLED",
    item_id="i1",
    item="X",
    name="Ann",
    price=None,
    line="QDCA10",
    location=None,
    loyalty=None,
    source=None,
):
    """One hub event as a tuple in schema order."""
    when = ts if isinstance(ts, datetime) else at(ts)
    return (
        f"{order}|{item_id}|{kind}|{status}|{when}",
        order,
        kind,
        when,
        source,
        location,
        loyalty,
        status,
        (item_id, item, name, price, status, line, None),
        "d",
        "t",
    )


def placed(order="o1", ts=0, item_id="i1", **other):
    return event(order=order, kind="ORDER_PLACED", status="PLACED", ts=ts, item_id=item_id, **other)


def cancelled(order="o1", ts=0, item_id="i1", **other):
    return event(
        order=order,
        kind="ORDER_CANCELLED",
        status="CANCELLED",
        ts=ts,
        item_id=item_id,
        line=None,
        **other,
    )
