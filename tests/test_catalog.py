from decimal import Decimal

import pytest
from conftest import at, cancelled, event, placed, rows

from orderloom import schemas
from orderloom.operators import customer, hub, pattern, stock, trends, turnover
from orderloom.plans import catalog


@pytest.fixture(scope="module")
def tables(spark):
    catalog.create_tables(spark)
    catalog.create_tables(spark)  # repeating it changes nothing
    catalog.publish_views(spark)
    return spark


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [
            placed("o1", 0, price=Decimal("3.00"), location="TOKYO", loyalty="L1"),
            event("o1", ts=60),
            placed("o2", 90000, item_id="i2", line="QDCA10PRO", name="Bob"),
            event("o2", ts=90060, item_id="i2", line="QDCA10PRO", name="Bob"),
            cancelled("o3", ts=7200, item_id="i3"),
        ],
        schemas.ORDER_EVENT,
    )


def test_views_show_what_the_operators_compute(tables, events):
    spark = tables
    inv = spark.createDataFrame(
        [("s1", "X", "RESTOCK_REQUESTED_EVENT", 1, at(7300))],
        "skuId string, item string, eventType string, quantity bigint, event_time timestamp",
    )
    restocks = stock.inventory_events(inv)
    history = customer.customer_history(events)
    lead = pattern.lead_times_enriched(events)
    partials = turnover.turnover_partials(restocks, events)
    for name, df in {
        "order_events_history": hub.history(events),
        "order_events_current": hub.current(events),
        "sales_trends_5m": trends.trends(events, trends.FIVE_MINUTES),
        "sales_trends_daily": trends.trends(events, trends.ONE_DAY),
        "component_stock_events": restocks,
        "component_stock_current": stock.stock_current(inv),
        "inventory_turnover": partials,
        "stockout_risk": turnover.stockout_risk_hourly(events),
        "qdca10_lead_time": lead.where("assembly_line = 'QDCA10'"),
        "qdca10pro_lead_time": lead.where("assembly_line = 'QDCA10PRO'"),
        "customer_events_history": history,
    }.items():
        catalog.insert(df, name)
    full = customer.profile_full(history)
    for view, want in {
        "order_events.order_events_history": hub.history(events),
        "order_events.orders_current": hub.current(events),
        "sales_trends.trends_5m": trends.trends(events, trends.FIVE_MINUTES),
        "sales_trends.trends_daily": trends.trends(events, trends.ONE_DAY),
        "component_stock.stock_events": restocks,
        "component_stock.stock_current": stock.stock_current(inv),
        "inventory_analytics.turnover": turnover.turnover(restocks, events),
        "inventory_analytics.stockout_risk": turnover.stockout_risk_hourly(events),
        "assembly_lead_time.all_lines": lead,
        "customer_360.profile_full": full,
        "customer_360.profile_masked": customer.profile_masked(full),
    }.items():
        got = spark.table(view)
        assert sorted(rows(got.select(*want.columns)), key=str) == sorted(rows(want), key=str), view
        assert not [c for c in got.columns if c.endswith(("_day", "_month"))]


def test_partitions_follow_the_layout(tables, events):
    catalog.insert(hub.history(events), "order_events_history")
    parts = {r[0] for r in tables.sql("SHOW PARTITIONS dataproducts.order_events_history").collect()}
    assert "event_timestamp_day=2024-03-02/event_type=ORDER_PLACED" in parts
    assert len(parts) == 5


def test_current_table_is_replaced(tables, events):
    catalog.overwrite_current(hub.current(events), "order_events_current")
    catalog.overwrite_current(hub.current(events), "order_events_current")
    assert tables.table("order_events.orders_current").count() == 3


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_key_that_moves_leaves_its_old_partition(tables, events, mode):
    setting = "spark.sql.sources.partitionOverwriteMode"
    tables.conf.set(setting, mode)
    try:
        for location in ("TOKYO", "RALEIGH"):
            one = tables.createDataFrame([placed("o1", 0, location=location)], schemas.ORDER_EVENT)
            catalog.overwrite_current(hub.current(one), "order_events_current")
        assert tables.conf.get(setting) == mode
    finally:
        tables.conf.unset(setting)
    found = tables.table("order_events.orders_current").select("order_id", "location")
    assert rows(found) == [("o1", "RALEIGH")]


def test_lead_times_of_both_lines_are_found_once(spark, monkeypatch):
    from orderloom.plans import registry

    found = spark.createDataFrame([("A", "QDCA10"), ("B", "QDCA10PRO")], "item_id string, assembly_line string")
    calls, inserted = [], {}
    monkeypatch.setattr(registry, "order_events", lambda *_: None)
    monkeypatch.setattr(registry, "customer_history", lambda *_: None)
    monkeypatch.setattr(registry.td, "item_status_events", lambda *_: None)
    monkeypatch.setattr(registry.pattern, "lead_times", lambda _: calls.append(1) or found)
    monkeypatch.setattr(registry.catalog, "insert", lambda df, name, _: inserted.update({name: df}))
    registry._views(spark, "once", "qdca10_lead_time", "qdca10pro_lead_time")
    assert len(calls) == 1
    files = [df.inputFiles() for df in inserted.values()]
    assert files[0] == files[1] != []
    assert {n: [r.item_id for r in df.collect()] for n, df in inserted.items()} == {
        "qdca10_lead_time": ["A"],
        "qdca10pro_lead_time": ["B"],
    }
