import random
from datetime import datetime
from decimal import Decimal

from conftest import at, cancelled, event, placed, rows

from orderloom import schemas
from orderloom.operators import assembly, contracts, customer, stock, trends, turnover


def hub_frame(spark, *events):
    return spark.createDataFrame(list(events), schemas.ORDER_EVENT)


def test_trend_windows_and_null_groups(spark):
    df = hub_frame(
        spark,
        event(ts=0),
        event(ts=299, item_id="i2"),
        event(ts=300, item_id="i3"),
        event(ts=10, item_id="i4", line=None),
        placed(ts=10),
        event(ts=10, status="IN_PROGRESS"),
    )
    got = trends.trends(df, trends.FIVE_MINUTES)
    assert sorted(rows(got), key=str) == sorted(
        [
            ("X", at(0), at(300), 2, None, "QDCA10", None),
            ("X", at(300), at(600), 1, None, "QDCA10", None),
            ("X", at(0), at(300), 1, None, None, None),
        ],
        key=str,
    )
    assert trends.trends(df, trends.ONE_DAY).count() == 2


def test_revenue_that_does_not_fit_is_null(spark):
    big = Decimal("99999999.99")
    df = hub_frame(spark, *[event(ts=1, item_id=f"i{n}", price=big) for n in range(101)])
    assert trends.trends(df, trends.ONE_DAY).first()["revenue"] is None
    df = hub_frame(spark, *[event(ts=1, item_id=f"i{n}", price=big) for n in range(100)])
    assert trends.trends(df, trends.ONE_DAY).first()["revenue"] == Decimal("9999999999.00")


def test_enriched_trends_take_price_and_location_from_the_placement(spark):
    df = hub_frame(
        spark,
        placed(ts=0, price=Decimal("2.50"), location="TOKYO"),
        placed(ts=0, price=Decimal("2.50"), location="TOKYO"),  # replayed record
        event(ts=10),
        event(ts=20),
        event(ts=20, order="o9"),
        event(ts=20, order=None),
        placed(ts=0, order=None, price=Decimal("9.00"), location="RALEIGH"),
    )
    got = trends.trends_enriched(df, trends.ONE_DAY).select("order_count", "revenue", "location")
    assert sorted(rows(got), key=str) == [
        (2, Decimal("5.00"), "TOKYO"),
        (2, None, None),
    ]


INV = "skuId string, item string, eventType string, quantity bigint, event_time timestamp"
DEC = "item string, quantity bigint, event_time timestamp"


def test_stock_events_ids_and_codes(spark):
    df = spark.createDataFrame(
        [
            ("s1", "X", "RESTOCK_REQUESTED_EVENT", 1, at(0)),
            ("s1", "X", "RESTOCK_COMPLETED_EVENT", 1, at(1)),
            (None, "X", "SOMETHING", None, at(2)),
            (None, "X", None, None, at(3)),
        ],
        INV,
    )
    got = stock.inventory_events(df)
    assert [r[3] for r in sorted(rows(got), key=lambda r: r[4])] == [
        "RESTOCK_REQUESTED",
        "RESTOCK_COMPLETED",
        "SOMETHING",
        None,
    ]
    ids = {r["event_id"] for r in got.collect()}
    assert len(ids) == 4 and None not in ids
    assert ids == {r["event_id"] for r in stock.inventory_events(df).collect()}
    random = stock.inventory_events(df, random_ids=True)
    assert not ids & {r["event_id"] for r in random.collect()}


def test_latest_stock_status(spark):
    df = spark.createDataFrame(
        [
            ("s1", "X", "RESTOCK_COMPLETED_EVENT", 1, at(5)),
            ("s1", "X", "RESTOCK_REQUESTED_EVENT", 1, at(9)),
            ("s2", "Y", "RESTOCK_REQUESTED_EVENT", 1, at(1)),
        ],
        INV,
    )
    assert sorted(rows(stock.stock_current(df))) == [
        ("s1", "X", "RESTOCK_REQUESTED", at(9)),
        ("s2", "Y", "RESTOCK_REQUESTED", at(1)),
    ]


def test_quantity_from_restock_and_consumption(spark):
    inv = spark.createDataFrame(
        [
            ("s1", "X", "RESTOCK_COMPLETED_EVENT", 50, at(5)),
            ("s1", "X", "RESTOCK_REQUESTED_EVENT", 99, at(9)),
            ("s2", "Y", "RESTOCK_COMPLETED_EVENT", 7, at(5)),
            ("s3", "Z", "RESTOCK_COMPLETED_EVENT", 8, at(9)),
        ],
        INV,
    )
    dec = spark.createDataFrame([("X", 49, at(6)), ("Y", 6, at(5)), ("Z", 1, at(8))], DEC)
    assert sorted(rows(stock.stock_quantity(inv, dec))) == [
        ("X", 49, at(6)),
        ("Y", 6, at(5)),
        ("Z", 8, at(9)),
    ]


def test_turnover_forms_agree(spark):
    inv = spark.createDataFrame(
        [
            ("s1", "X", "RESTOCK_REQUESTED_EVENT", 1, at(0)),
            ("s1", "X", "RESTOCK_REQUESTED_EVENT", 1, at(3599)),
            ("s1", "X", "RESTOCK_COMPLETED_EVENT", 1, at(10)),
            ("s2", "Y", "RESTOCK_REQUESTED_EVENT", 1, at(3600)),
        ],
        INV,
    )
    events = hub_frame(spark, cancelled(ts=5), cancelled(ts=7, item="Z"), event(ts=5))
    restocks = stock.inventory_events(inv)
    want = [
        ("X", at(0), at(3600), 2, 1),
        ("Y", at(3600), at(7200), 1, 0),
        ("Z", at(0), at(3600), 0, 1),
    ]
    assert sorted(rows(turnover.turnover(restocks, events))) == want
    partials = turnover.turnover_partials(restocks, events)
    assert partials.count() == 4
    assert sorted(rows(turnover.turnover_from_partials(partials))) == want


def test_stockout_risk_forms(spark):
    events = hub_frame(spark, cancelled(ts=5), cancelled(ts=7), cancelled(ts=4000), event(ts=9))
    assert rows(turnover.stockout_risk_current(events)) == [("X", True, at(4000))]
    assert sorted(rows(turnover.stockout_risk_hourly(events))) == [
        ("X", True, at(7)),
        ("X", True, at(4000)),
    ]


def test_customer_profile_keeps_last_non_null(spark):
    events = hub_frame(
        spark,
        placed("o1", 0, loyalty="L1", location="TOKYO"),
        placed("o1", 0, item_id="i2", loyalty="L1", location="TOKYO"),
        placed("o2", 10, loyalty=None, location=None),
        placed("o3", 5, name="Bob", loyalty="L2"),
        placed("o4", 6, name="Bob", loyalty=""),
        placed("o5", 1, name=""),
        placed("o6", 1, name=None),
        event("o7", ts=99),
    )
    got = customer.customer_360_current(events)
    assert got.columns[-1] == "updatedAt"
    assert sorted(rows(got.drop("updatedAt"))) == [
        ("Ann", "L1", "TOKYO", "o2", at(10), 2),
        ("Bob", "", None, "o4", at(6), 2),
    ]
    full = customer.profile_full(customer.customer_history(events))
    assert sorted(rows(full)) == [
        ("Ann", None, None, "o2", at(10), 3),
        ("Bob", "", None, "o4", at(6), 2),
    ]


def test_equal_times_have_one_answer(spark):
    events = [placed(f"o{n}", 0, loyalty=f"L{n}") for n in range(20)]
    for order in (events, events[::-1]):
        df = hub_frame(spark, *order).repartition(7)
        row = customer.profile_full(customer.customer_history(df)).first()
        assert (row["last_order_id"], row["loyalty_member_id"]) == ("o9", "L9")


def test_masking(spark):
    full = spark.createDataFrame(
        [("A", None), ("Ören", "L1"), ("Zoë", "")], "customer_name string, loyalty_member_id string"
    )
    masked = rows(customer.profile_masked(full))
    assert masked == [("A***", None), ("Ö***", "***"), ("Z***", "***")]
    assert rows(customer.profile_for_group(full, "consumer")) == masked
    both = customer.profiles_for_groups(full, ("customer360-full", "consumer"))
    assert both.columns == ["caller_group", *full.columns]
    assert rows(both.where("caller_group = 'consumer'").drop("caller_group")) == masked
    assert rows(both.where("caller_group <> 'consumer'").drop("caller_group")) == rows(full)
    assert rows(customer.profile_for_group(full, "customer360-full")) == rows(full)


def test_contract_violations(spark):
    good = placed(price=Decimal("1.00"), location="TOKYO", source="WEB")
    df = hub_frame(spark, good, cancelled(name=None), event(line="OTHER", location="PARIS"))
    got = {(r[1], r[2]): r[3] for r in rows(contracts.violations(df, contracts.ORDER_EVENT))}
    assert got == {
        ("lineItem.name", "required"): 1,
        ("lineItem.price", "required"): 2,
        ("lineItem.lineItemStatus", "allowed values"): 1,
        ("lineItem.assemblyLine", "allowed values"): 1,
        ("location", "allowed values"): 1,
    }


def test_completion_contract(spark):
    df = spark.createDataFrame(
        [
            ("o", "l", "X", "Ann", "2024-03-01T00:00:01.500Z", None),
            ("o", "l", "X", "Ann", "yesterday", "h"),
            ("o", None, "X", "Ann", "2024-03-01T00:00:02Z", "h"),
        ],
        schemas.COMPLETION,
    )
    got = contracts.completion_contract(df).select("completed_at", "conforms")
    assert rows(got) == [(at(1.5), True), (None, False), (at(2), False)]


def test_order_assembly_sessions(spark):
    times = [0, 3, 8, 13.001, 30, 4.999, 30]
    df = hub_frame(
        spark, *[placed(ts=t, item_id=f"i{n}", price=Decimal("1")) for n, t in enumerate(times)]
    )
    got = sorted(rows(assembly.order_assembly(df, gap_seconds=5)))
    assert got == [
        ("o1", at(0), at(8), 4, Decimal("4.00")),
        ("o1", at(13.001), at(13.001), 1, Decimal("1.00")),
        ("o1", at(30), at(30), 2, Decimal("2.00")),
    ]
    streamed = sorted(rows(assembly.order_assembly_stream(df, gap_seconds=5)))
    assert streamed == got


def test_rows_without_a_time_are_dropped_everywhere(spark):
    timeless = [(*e[:3], None, *e[4:]) for e in (cancelled("o9", item_id="i9"), event("o9"), placed("o9"))]
    events = spark.createDataFrame([cancelled("o1", ts=5), *timeless], schemas.ORDER_EVENT)
    assert turnover.stockout_risk_current(events).count() == 1
    assert turnover.stockout_risk_hourly(events).count() == 1
    assert trends.trends(events, trends.ONE_DAY).count() == 0
    assert assembly.order_assembly(events).count() == 0


def test_packed_quantities_order_as_time_rank_and_quantity_do(spark):
    """Against the maximum of tuples in which NULL comes first, at the ends of both ranges."""
    rng = random.Random(4)
    times = [None, datetime(1, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999_999), at(0), at(1), datetime(9999, 12, 31)]
    numbers = [None, -(2**63), -1, 0, 1, 2**63 - 1]
    inv, dec, want = [], [], {}
    for i in range(200):
        for _ in range(rng.randint(1, 4)):
            t, q, rank = rng.choice(times), rng.choice(numbers), rng.randint(0, 1)
            (dec if rank else inv).append((f"i{i}", q, t))
            mine = (t is not None, t or datetime.min, rank, q is not None, q or 0, q, t)
            want[f"i{i}"] = max(want.get(f"i{i}", mine), mine, key=lambda r: r[:5])
    schema = "item string, quantity long, event_time timestamp_ntz"
    done = spark.createDataFrame(inv, schema).selectExpr("*", "'RESTOCK_COMPLETED_EVENT' AS eventType")
    got = stock.stock_quantity(done, spark.createDataFrame(dec, schema))
    assert {r.item: (r.quantity, r.last_restocked_at) for r in got.collect()} == {
        i: (r[5], r[6]) for i, r in want.items()
    }
    plan = got._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
