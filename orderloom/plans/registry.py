"""Named queries over the test tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import as_wall_time
from orderloom.operators import (
    assembly,
    contracts,
    customer,
    hub,
    pattern,
    stock,
    trends,
    turnover,
)
from orderloom.plans import catalog, oracle
from orderloom.schemas import EVENT_TYPES, INVENTORY_OUT, LINE_A, LINE_B, ORDERS_UP
from orderloom.session import shared_dir, state_in_rocksdb, use_slowest, use_utc
from orderloom.sinks import lake
from orderloom.sinks.targets import Target, read_target, set_stream
from orderloom.sources import testdata as td
from orderloom.sources import topics
from orderloom.sources.replayed import as_stream
from orderloom.streaming import jobs
from orderloom.streaming.lead_time import lead_time_stream
from orderloom.streaming.profile import customer_profile_stream
from orderloom.streaming.replay import finish, replay_append, replay_keyed, replay_measured

Query = Callable[[SparkSession, str], DataFrame]


def order_events(spark: SparkSession, sf: str, stream: bool = False) -> DataFrame:
    """The hub, the same for all consumers."""
    return hub.order_events(
        td.orders_in(spark, sf, stream),
        td.orders_up(spark, sf, stream),
        td.eighty_six(spark, sf, stream),
    )


def watermarked_hub(spark: SparkSession, sf: str) -> DataFrame:
    """The hub as a stream whose raw topics carry their watermarks, for jobs that set no later one."""
    topics_of_hub = (td.orders_in, td.orders_up, td.eighty_six)
    return hub.order_events(*[jobs.raw(topic(spark, sf, stream=True)) for topic in topics_of_hub])


def replayed_cancellations(spark: SparkSession, sf: str) -> DataFrame:
    """Cancellations on the calendar of the stock events."""
    return hub.cancelled_events(td.eighty_six(spark, sf, replay=True))


def stock_events(spark: SparkSession, sf: str) -> DataFrame:
    return stock.inventory_events(td.inventory_out(spark, sf))


def customer_history(spark: SparkSession, sf: str) -> DataFrame:
    return customer.customer_history(order_events(spark, sf))


def flat(events: DataFrame) -> DataFrame:
    """Line item fields as columns, so that any client can compare the rows."""
    return events.select("*", "lineItem.*").drop("lineItem")


def _profile_for_group(spark: SparkSession, sf: str) -> DataFrame:
    full = customer.profile_full(customer_history(spark, sf))
    return customer.profiles_for_groups(full, ("customer360-full", "consumer"))


def _contract_products() -> dict[str, tuple[Query, contracts.Contract]]:
    """Every product under contract, and the frame that its contract is checked on."""
    ev, se = order_events, stock_events
    return {
        "order_event": (ev, contracts.ORDER_EVENT),
        "stock_event": (se, contracts.STOCK_EVENT),
        "stock_quantity": (
            lambda s, d: stock.stock_quantity(td.inventory_out(s, d), td.stock_decrement(s, d)),
            contracts.STOCK_QUANTITY,
        ),
        "sales_trend": (
            lambda s, d: trends.trends(ev(s, d), trends.ONE_DAY),
            contracts.SALES_TREND,
        ),
        "turnover": (
            lambda s, d: turnover.turnover(se(s, d), replayed_cancellations(s, d)),
            contracts.TURNOVER,
        ),
        "stockout_risk": (
            lambda s, d: turnover.stockout_risk_hourly(ev(s, d)),
            contracts.STOCKOUT_RISK,
        ),
        "lead_time": (
            lambda s, d: pattern.lead_times(td.item_status_events(s, d)),
            contracts.LEAD_TIME,
        ),
        "customer_profile": (
            lambda s, d: customer.customer_360_current(ev(s, d)),
            contracts.CUSTOMER_PROFILE,
        ),
        "completion": (td.completion_messages, contracts.COMPLETION),
    }


def _contract_query(frame: Query, contract: contracts.Contract) -> Query:
    return lambda s, d: contracts.violations(frame(s, d), contract)


def _contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The four contracts of the event and profile products in one result."""
    products = _contract_products()
    out = None
    for name in ("order_event", "stock_event", "sales_trend", "customer_profile"):
        frame, contract = products[name]
        found = contracts.violations(frame(spark, sf), contract)
        out = found if out is None else out.unionByName(found)
    return out


# tables that this process has filled already, by database
_published: set[tuple[str, str]] = set()


def _views(spark: SparkSession, sf: str, *names: str) -> None:
    """Fill the tables ``names`` of a folder's own database and publish the views over it."""
    events, history = order_events(spark, sf), customer_history(spark, sf)
    app = spark.sparkContext.applicationId.replace("-", "_")
    database = f"orderloom_{app}_{uuid.uuid5(uuid.NAMESPACE_URL, sf).hex}"

    @functools.cache
    def lead() -> DataFrame:
        """Both lines' lead times, found once and stored: each line's table is a part of them."""
        path, found = shared_dir(spark, "tables"), pattern.lead_times(td.item_status_events(spark, sf))
        found.write.parquet(path)
        return spark.read.schema(found.schema).parquet(path)

    frames = {
        "order_events_current": lambda: hub.current(events),
        "customer_events_history": lambda: history,
        "inventory_turnover": lambda: turnover.turnover_partials(
            stock_events(spark, sf), replayed_cancellations(spark, sf)
        ),
        "qdca10_lead_time": lambda: lead().where(F.col("assembly_line") == LINE_A),
        "qdca10pro_lead_time": lambda: lead().where(F.col("assembly_line") == LINE_B),
    }
    catalog.create_tables(spark, database)
    for name in names:
        if (database, name) not in _published:
            catalog.insert(frames[name](), name, database)
            _published.add((database, name))
    catalog.publish_views(spark, database)


def _view(view: str, *names: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        _views(spark, sf, *names)
        return spark.table(view)

    return query


def _json_strict(spark: SparkSession, sf: str) -> DataFrame:
    topic = topics.to_json_topic(td.orders_up(spark, sf))
    return topics.decode_json(topic, ORDERS_UP)


def _stock_text(spark: SparkSession, sf: str) -> DataFrame:
    """Stock messages as text, of which some are bare words and some carry a badly typed quantity."""
    rows = td.inventory_out(spark, sf)
    good = F.to_json(F.struct("skuId", "item", "eventType", "quantity"))
    bad_field = F.to_json(
        F.struct("skuId", "item", "eventType", F.lit("many").alias("quantity"))
    )
    value = (
        F.when(F.col("quantity") % 5 == 0, F.col("item"))
        .when(F.col("quantity") % 7 == 3, bad_field)
        .otherwise(good)
    )
    return rows.select(value.alias("value"), F.col("event_time").alias("timestamp"))


def _json_lenient(spark: SparkSession, sf: str) -> DataFrame:
    return topics.decode_json(_stock_text(spark, sf), INVENTORY_OUT, lenient=True)


def _batch() -> dict[str, Query]:
    ev, replayed, se = order_events, replayed_cancellations, stock_events
    return {
        "order_placed_events": lambda s, d: flat(hub.placed_events(td.orders_in(s, d))),
        "line_status_events": lambda s, d: flat(hub.status_events(td.orders_up(s, d))),
        "cancelled_events": lambda s, d: flat(hub.cancelled_events(td.eighty_six(s, d))),
        "order_events": lambda s, d: flat(ev(s, d)),
        "order_events_history": lambda s, d: hub.history(ev(s, d)),
        "order_events_current": lambda s, d: hub.current(ev(s, d)),
        "trends_5m": lambda s, d: trends.trends(ev(s, d), trends.FIVE_MINUTES),
        "trends_daily": lambda s, d: trends.trends(ev(s, d), trends.ONE_DAY),
        "trends_enriched": lambda s, d: trends.trends_enriched(ev(s, d), trends.ONE_DAY),
        "inventory_events": se,
        "stock_current": lambda s, d: stock.stock_current(td.inventory_out(s, d)),
        "stock_quantity": lambda s, d: stock.stock_quantity(
            td.inventory_out(s, d), td.stock_decrement(s, d)
        ),
        "turnover_partials": lambda s, d: turnover.turnover_partials(se(s, d), replayed(s, d)),
        "turnover": lambda s, d: turnover.turnover(se(s, d), replayed(s, d)),
        "turnover_from_partials": lambda s, d: turnover.turnover_from_partials(
            turnover.turnover_partials(se(s, d), replayed(s, d))
        ),
        "stockout_risk_current": lambda s, d: turnover.stockout_risk_current(ev(s, d)),
        "stockout_risk_hourly": lambda s, d: turnover.stockout_risk_hourly(ev(s, d)),
        "lead_time_line_a": lambda s, d: pattern.lead_times(
            td.item_status_events(s, d), lines=(LINE_A,)
        ),
        "lead_time_line_b": lambda s, d: pattern.lead_times(
            td.item_status_events(s, d), lines=(LINE_B,)
        ),
        "lead_time_all_lines": lambda s, d: pattern.lead_times(td.item_status_events(s, d)),
        "lead_time_on_hub": lambda s, d: pattern.lead_times(ev(s, d)),
        "lead_time_enriched": lambda s, d: pattern.lead_times_enriched(ev(s, d)),
        "customer_360_current": lambda s, d: customer.customer_360_current(
            ev(s, d), with_updated_at=False
        ),
        "customer_history": customer_history,
        "profile_full": lambda s, d: customer.profile_full(customer_history(s, d)),
        "profile_masked": lambda s, d: customer.profile_masked(
            customer.profile_full(customer_history(s, d))
        ),
        "profile_for_group": _profile_for_group,
        "completion_contract": lambda s, d: contracts.completion_contract(
            td.completion_messages(s, d)
        ),
        "contract_violations": _contract_violations,
        "order_assembly": lambda s, d: assembly.order_assembly(ev(s, d)),
        "json_strict_completions": _json_strict,
        "json_lenient_stock": _json_lenient,
        "inventory_events_lake": _inventory_events_lake,
        "inventory_events_days": lambda s, d: _inventory_events_days(s, d, *STOCK_DAYS),
        "view_orders_current": _view("order_events.orders_current", "order_events_current"),
        "view_turnover": _view("inventory_analytics.turnover", "inventory_turnover"),
        "view_all_lines": _view(
            "assembly_lead_time.all_lines", "qdca10_lead_time", "qdca10pro_lead_time"
        ),
        "view_profile_full": _view("customer_360.profile_full", "customer_events_history"),
        "view_profile_masked": _view("customer_360.profile_masked", "customer_events_history"),
        **{
            f"contract_{name}": _contract_query(*x) for name, x in _contract_products().items()
        },
    }


STOCK_DAYS = ("2024-01-05", "2024-01-14")


def _stock_lake(spark: SparkSession, sf: str) -> tuple[str, T.StructType, list[lake.Transform]]:
    """The stock events as a lake table partitioned by day."""
    path, by_day = shared_dir(spark, "tables"), [lake.day("event_timestamp")]
    events = stock_events(spark, sf)
    lake.append(events, path, by_day)
    return path, events.schema, by_day


def _inventory_events_lake(spark: SparkSession, sf: str) -> DataFrame:
    return lake.read(spark, *_stock_lake(spark, sf))


def _inventory_events_days(spark: SparkSession, sf: str, first: str, last: str) -> DataFrame:
    """The rows of some days; only their partitions are read."""
    return lake.read_days(spark, *_stock_lake(spark, sf), first, last)


def _customer_360_stream(spark: SparkSession, sf: str) -> DataFrame:
    placed = hub.placed_events(td.orders_in(spark, sf, stream=True))
    key = ["customer_name"]
    # a state row for each order: kept on disk, and a batch copies and stores its changes only
    with state_in_rocksdb(spark):
        return jobs.customer_profile(
            replay_keyed(spark, jobs.customer_last_seen_stream(placed), key),
            replay_keyed(spark, jobs.customer_order_count_stream(placed), key),
        )


def _turnover_stream(spark: SparkSession, sf: str) -> DataFrame:
    restocks = stock.inventory_events(td.inventory_out(spark, sf, stream=True))
    cancelled = hub.cancelled_events(td.eighty_six(spark, sf, stream=True, replay=True))
    return replay_append(
        spark, jobs.turnover_stream(restocks, cancelled), [lake.day("window_start")]
    )


def _turnover_partials_stream(spark: SparkSession, sf: str) -> DataFrame:
    restocks = stock.inventory_events(td.inventory_out(spark, sf, stream=True))
    cancelled = hub.cancelled_events(td.eighty_six(spark, sf, stream=True, replay=True))
    return replay_append(
        spark, jobs.turnover_partials_stream(restocks, cancelled), [lake.day("window_start")]
    )


def _stock_quantity_stream(spark: SparkSession, sf: str) -> DataFrame:
    reports = jobs.stock_quantity_stream(
        jobs.raw(td.inventory_out(spark, sf, stream=True)),
        jobs.raw(td.stock_decrement(spark, sf, stream=True)),
    )
    return replay_keyed(spark, reports, ["item"])


def _lead_time_stream(spark: SparkSession, sf: str) -> DataFrame:
    with state_in_rocksdb(spark):
        return replay_append(spark, lead_time_stream(td.item_status_events(spark, sf, stream=True)))


def _customer_profile_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Without the time of the update, which no two runs share."""
    placed = hub.placed_events(td.orders_in(spark, sf, stream=True))
    with state_in_rocksdb(spark):
        profiles = replay_keyed(spark, customer_profile_stream(placed), ["customerName"])
    return profiles.drop("updatedAt")


def _trends_enriched_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.trends_enriched_stream(
        hub.status_events(td.orders_up(spark, sf, stream=True)),
        hub.placed_events(td.orders_in(spark, sf, stream=True)),
        trends.ONE_DAY,
    )
    with state_in_rocksdb(spark):
        return replay_append(spark, stream)


def _trends_on_stored_hub(spark: SparkSession, sf: str) -> DataFrame:
    """One query stores the hub, another reads it there: raw topics are read by the first alone."""
    events, by_type = watermarked_hub(spark, sf), [lake.identity("eventType")]
    path, checkpoint = shared_dir(spark, "tables"), shared_dir(spark, "checkpoints")
    finish(lake.append_stream(events, path, checkpoint, by_type, {"availableNow": True}))
    stored = lake.read_stream(spark, path, events.schema, by_type)
    return replay_append(spark, jobs.trends_stream(stored, trends.ONE_DAY), [lake.month("window_start")])


def _late_trends(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Trends of completions of which some arrive two years late, and the batches' figures."""
    late = hub.status_events(td.orders_up_late(spark, sf, stream=True))
    return replay_measured(spark, jobs.trends_stream(late, trends.ONE_DAY))


def _run_set(spark: SparkSession, stream: DataFrame, targets: list[Target]) -> str:
    path = shared_dir(spark, "tables")
    checkpoint = shared_dir(spark, "checkpoints")
    finish(set_stream(stream, path, checkpoint, targets, {"availableNow": True}))
    return path


HISTORY_LAYOUT = (lake.month("event_timestamp"), lake.identity("event_type"))


def _event_targets() -> list[Target]:
    """Each event type's topic records, keyed by order, and the history of all of them."""

    def records(kind: str) -> Target:
        own = lambda b: topics.to_keyed_records(b.where(F.col("eventType") == kind), "orderId")
        return Target(kind.lower(), own)

    return [*[records(kind) for kind in EVENT_TYPES], Target("history", hub.history, HISTORY_LAYOUT)]


def _order_events_set_stream(spark: SparkSession, sf: str) -> DataFrame:
    """What the set's targets hold after the hub was read once: the history's events, and of the
    topic records the event that is in their text."""
    events = watermarked_hub(spark, sf)
    path = _run_set(spark, events, _event_targets())
    history = hub.history(events).schema
    out = read_target(spark, path, "history", history, HISTORY_LAYOUT).select(
        F.lit("history").alias("target"), "event_id", "order_id", "event_type"
    )
    keyed_record = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "value")])
    for kind in EVENT_TYPES:
        own = read_target(spark, path, kind.lower(), keyed_record)
        found = [F.get_json_object("value", f"$.{c}") for c in ("eventId", "eventType")]
        own = own.select(F.lit(kind.lower()), found[0], "key", found[1])
        out = out.union(own)
    return out


def _checked_stock(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Raw text in, the accepted records and the quarantine out: one read, one set."""
    text = as_stream(_stock_text(spark, sf), "stock_text", sf, "timestamp", *td.STOCK_CALENDAR)
    checked = topics.check_json(text, INVENTORY_OUT)
    targets = [Target("records", topics.accepted), Target("quarantine", topics.quarantined)]
    path = _run_set(spark, checked, targets)
    return {t.name: read_target(spark, path, t.name, t.rows(checked).schema) for t in targets}


def _streams() -> dict[str, Query]:
    """Streaming forms, each run over the whole tables until nothing is left to read."""

    def cancelled(s: SparkSession, d: str) -> DataFrame:
        return hub.cancelled_events(td.eighty_six(s, d, stream=True))

    return {
        "order_events_stream": lambda s, d: replay_append(
            s,
            hub.history(watermarked_hub(s, d)),
            [lake.day("event_timestamp"), lake.identity("event_type")],
        ),
        "inventory_events_stream": lambda s, d: replay_append(
            s,
            stock.inventory_events(jobs.raw(td.inventory_out(s, d, stream=True))),
            [lake.day("event_timestamp")],
        ),
        "customer_history_stream": lambda s, d: replay_append(
            s,
            jobs.customer_history_stream(hub.placed_events(td.orders_in(s, d, stream=True))),
            [lake.day("event_timestamp")],
        ),
        "turnover_partials_stream": _turnover_partials_stream,
        "trends_5m_stream": lambda s, d: replay_append(
            s,
            jobs.trends_stream(order_events(s, d, stream=True), trends.FIVE_MINUTES),
            [lake.day("window_start")],
        ),
        "trends_daily_stream": lambda s, d: replay_append(
            s,
            jobs.trends_stream(order_events(s, d, stream=True), trends.ONE_DAY),
            [lake.month("window_start")],
        ),
        "trends_daily_stored_hub_stream": _trends_on_stored_hub,
        "trends_late_stream": lambda s, d: _late_trends(s, d)[0],
        "trends_late_batches_stream": lambda s, d: _late_trends(s, d)[1],
        "trends_enriched_stream": _trends_enriched_stream,
        "turnover_stream": _turnover_stream,
        "stockout_risk_hourly_stream": lambda s, d: replay_append(
            s, jobs.stockout_risk_hourly_stream(cancelled(s, d))
        ),
        "stockout_risk_current_stream": lambda s, d: replay_keyed(
            s, jobs.stockout_risk_current_stream(cancelled(s, d)), ["item"]
        ),
        "stock_current_stream": lambda s, d: replay_keyed(
            s, jobs.stock_current_stream(jobs.raw(td.inventory_out(s, d, stream=True))), ["sku_id"]
        ),
        "stock_quantity_stream": _stock_quantity_stream,
        "customer_360_current_stream": _customer_360_stream,
        "customer_profile_stream": _customer_profile_stream,
        "order_events_set_stream": _order_events_set_stream,
        "json_lenient_stock_stream": lambda s, d: _checked_stock(s, d)["records"],
        "json_quarantine_stream": lambda s, d: _checked_stock(s, d)["quarantine"],
        "lead_time_stream": _lead_time_stream,
        "order_assembly_stream": lambda s, d: replay_append(
            s,
            jobs.order_assembly_stream(
                hub.placed_events(td.orders_in(s, d, stream=True))
            ),
        ),
    }


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return as_wall_time(query(use_slowest(use_utc(spark)), sf))

    return run


def queries() -> dict[str, Query]:
    return {name: _prepared(q) for name, q in {**_batch(), **_streams()}.items()}


def oracle_sql() -> dict[str, str]:
    return {**oracle.batch_sql(), **oracle.stream_sql()}
