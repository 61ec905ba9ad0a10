import hashlib
from decimal import Decimal

import pytest
from conftest import at, cancelled, event, placed, rows
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators import hub
from orderloom.plans import registry
from orderloom.sources import topics

ORDERS_IN = "id string, orderSource string, location string, loyaltyMemberId string, "
LINE = "array<struct<itemId:string,item:string,name:string,price:decimal(10,2)>>"
ORDERS_IN += f"qdca10LineItems {LINE}, qdca10proLineItems {LINE}, event_time timestamp"


def orders(spark, *records):
    return spark.createDataFrame(list(records), ORDERS_IN)


def line(n):
    return (f"l{n}", "X", "Ann", Decimal("1.50"))


def test_unnest_null_empty_and_both_arrays(spark):
    df = orders(
        spark,
        ("a", "WEB", "TOKYO", "", None, None, at(0)),
        ("b", "WEB", "TOKYO", "", [], [], at(0)),
        ("c", "WEB", "TOKYO", "", [line(1), line(2)], [line(3)], at(0)),
    )
    got = hub.placed_events(df).select("orderId", "lineItem.itemId", "lineItem.assemblyLine")
    assert sorted(rows(got)) == [
        ("c", "l1", "QDCA10"),
        ("c", "l2", "QDCA10"),
        ("c", "l3", "QDCA10PRO"),
    ]


def test_event_id_is_stable_and_null_aware(spark):
    df = orders(
        spark,
        ("a", None, None, None, [line(1)], None, at(7)),
        (None, None, None, None, [line(1)], None, at(7)),
    )
    ids = {r[0]: r[1] for r in rows(hub.placed_events(df).select("orderId", "eventId"))}
    text = "a|l1|ORDER_PLACED|2024-03-01 00:00:07.000"
    assert ids == {"a": hashlib.md5(text.encode()).hexdigest(), None: None}


def test_hub_schema_matches_the_contract(spark):
    df = hub.placed_events(orders(spark, ("a", None, None, None, [line(1)], None, at(0))))
    flat = [(f.name, f.dataType.simpleString()) for f in df.schema]
    assert flat == [(f.name, f.dataType.simpleString()) for f in schemas.ORDER_EVENT]


@pytest.mark.parametrize(
    "host,expected",
    [
        ("qdca10pro-1", ("QDCA10PRO", "qdca10pro")),
        ("qdca10-1", ("QDCA10", "qdca10")),
        ("QDCA10-1", (None, None)),
        ("other", (None, None)),
        (None, (None, None)),
    ],
)
def test_line_from_host_prefix(spark, host, expected):
    up = spark.createDataFrame(
        [("o", "l", "X", "Ann", host, at(0))],
        "orderId string, lineItemId string, item string, name string, madeBy string, "
        "event_time timestamp",
    )
    got = hub.status_events(up).select("lineItem.assemblyLine", "sourceDomain")
    assert rows(got) == [expected]


def test_cancelled_lines_know_only_id_and_item(spark):
    df = spark.createDataFrame(
        [("o", "l", "X", at(0))],
        "orderId string, lineItemId string, item string, event_time timestamp",
    )
    got = hub.cancelled_events(df).select("lineItem.*", "orderStatus", "sourceDomain")
    assert rows(got) == [("l", "X", None, None, None, None, None, "CANCELLED", "qdca10")]


@pytest.mark.parametrize("kind", schemas.EVENT_TYPES)
def test_filter_on_type_reads_one_source_only(spark, kind):
    events = registry.order_events(spark, "/root/testdata/sf0.001")
    plan = events.where(F.col("eventType") == kind)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Relation [l_orderkey") == 1


def test_current_order_state(spark):
    events = spark.createDataFrame(
        [
            placed(ts=0, location="TOKYO", source="WEB", loyalty="L1"),
            event(ts=60, line="QDCA10PRO"),
            cancelled(ts=60, item_id="i2"),
            event(order="o2", ts=5, line=None),
        ],
        schemas.ORDER_EVENT,
    )
    got = sorted(rows(hub.current(events)))
    assert got == [
        ("o1", "CANCELLED", "WEB", "TOKYO", "L1", at(0), at(60), "QDCA10PRO"),
        ("o2", "FULFILLED", None, None, None, None, at(5), None),
    ]


def test_history_is_flat(spark):
    events = spark.createDataFrame([placed(price=Decimal("2.00"))], schemas.ORDER_EVENT)
    row = hub.history(events).first()
    assert row["line_item_name"] == "Ann" and row["line_item_price"] == Decimal("2.00")
    assert len(row) == 15 and "item" not in row.asDict()


TOPIC = "value string, timestamp timestamp"


def test_lenient_json_skips_non_objects_and_nulls_bad_fields(spark):
    values = [
        "QDC_A104_AC",
        '"quoted"',
        '"{\\"item\\":\\"x\\"}"',
        '{"a":',
        "",
        None,
        "[1]",
        '{"item":"x","quantity":"bad"}',
        '{"item":"y"}',
        '{"item":"z","quantity":3,"other":1}',
    ]
    topic = spark.createDataFrame([(v, at(0)) for v in values], TOPIC)
    got = topics.decode_json(topic, schemas.STOCK_DECREMENT, lenient=True)
    assert sorted(rows(got.select("item", "quantity")), key=str) == [
        ("x", None),
        ("y", None),
        ("z", 3),
    ]


def test_strict_json_fails_on_bad_records(spark):
    good = spark.createDataFrame([('{"orderId":"o"}', at(0))], TOPIC)
    assert rows(topics.decode_json(good, schemas.EIGHTY_SIX)) == [("o", None, None, at(0))]
    bad = spark.createDataFrame([("plain text", at(0))], TOPIC)
    with pytest.raises(Exception, match="MALFORMED"):
        topics.decode_json(bad, schemas.EIGHTY_SIX).collect()


def test_record_time_is_cut_to_milliseconds(spark):
    topic = spark.createDataFrame([('{"orderId":"o"}', at(1.2345678))], TOPIC)
    assert topics.decode_json(topic, schemas.EIGHTY_SIX).first()["event_time"] == at(1.234)


def test_json_topic_roundtrip_and_keyed_records(spark):
    df = spark.createDataFrame(
        [("o", "l", "X", at(0))],
        "orderId string, lineItemId string, item string, event_time timestamp",
    )
    again = topics.decode_json(topics.to_json_topic(df), schemas.EIGHTY_SIX)
    assert rows(again) == rows(df)
    assert topics.to_keyed_records(df, "orderId").first()["key"] == "o"
    assert topics.to_keyed_records(df, None).columns == ["value"]
