"""Streams are replayed from ordered JSON files and compared with the batch results."""

import glob
import itertools
import json
import os
import random
import tempfile
import threading
import time
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import at, cancelled, event, placed, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas
from orderloom.operators import contracts, customer, pattern, stock, trends, turnover
from orderloom.plans import registry
from orderloom.session import state_in_rocksdb, use_rocksdb, use_slowest
from orderloom.sinks import keyed, lake
from orderloom.sinks.targets import Target, newest_mark, read_target, set_stream, write_set
from orderloom.sources import replayed, testdata, topics
from orderloom.streaming import jobs, segments
from orderloom.streaming.lead_time import follow, in_order, lead_time_stream
from orderloom.streaming.profile import customer_profile_stream
from orderloom.streaming.replay import ended_queries, replay_measured, summary


def write_files(spark, folder, batches, schema):
    """One JSON file per batch, each one second newer than the one before."""
    os.makedirs(folder, exist_ok=True)
    for n, batch in enumerate(batches):
        lines = spark.createDataFrame(batch, schema).select(F.to_json(F.struct("*"))).collect()
        name = f"{folder}/{n:04}.json"
        with open(name, "w") as out:
            out.write("\n".join(r[0] for r in lines) + "\n")
        os.utime(name, (1_700_000_000 + n, 1_700_000_000 + n))


def read_files(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def hub_stream(spark, folder, batches):
    write_files(spark, folder, batches, schemas.ORDER_EVENT)
    return read_files(spark, folder, schemas.ORDER_EVENT)


def run_append(stream, folder, transforms=()):
    q = lake.append_stream(
        stream, f"{folder}/out", f"{folder}/ck", transforms, {"availableNow": True}
    )
    q.awaitTermination()
    schema = lake.partitioned(stream, transforms).schema
    return stream.sparkSession.read.schema(schema).parquet(f"{folder}/out")


def run_keyed(stream, folder, keys):
    q = keyed.upsert_stream(stream, f"{folder}/out", f"{folder}/ck", {"availableNow": True})
    q.awaitTermination()
    schema = T.StructType(stream.schema.fields)
    return keyed.read_latest(stream.sparkSession, f"{folder}/out", keys, schema)


def test_trends_stream_equals_batch_on_closed_windows(spark, tmp_path):
    batches = [
        [event(ts=t, item_id=f"i{t}", price=Decimal("1.00")) for t in range(0, 290, 30)],
        [event(ts=295), event(ts=305, item="Y"), placed(ts=306)],
        [event(ts=620, item="Z")],
    ]
    stream = jobs.trends_stream(hub_stream(spark, f"{tmp_path}/in", batches), trends.FIVE_MINUTES)
    got = run_append(stream, str(tmp_path))
    everything = spark.createDataFrame(sum(batches, []), schemas.ORDER_EVENT)
    want = trends.trends(everything, trends.FIVE_MINUTES).where(F.col("window_end") <= at(610))
    assert sorted(rows(got)) == sorted(rows(want)) and want.count() == 2


def test_rows_that_do_not_count_still_advance_event_time(spark, tmp_path):
    batches = [[event(ts=0)], [placed(ts=400)], [placed(ts=401)]]
    stream = jobs.trends_stream(hub_stream(spark, f"{tmp_path}/in", batches), trends.FIVE_MINUTES)
    assert run_append(stream, str(tmp_path)).count() == 1


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    # a batch drops what was late before the batch ahead of it
    times = [0, 1000, 1001, 1, 2000]
    batches = [[event(ts=t, item_id=f"i{t}")] for t in times]
    stream = jobs.trends_stream(hub_stream(spark, f"{tmp_path}/in", batches), trends.FIVE_MINUTES)
    counts = {r["window_start"]: r["order_count"] for r in run_append(stream, str(tmp_path)).collect()}
    assert counts[at(0)] == 1


def test_enriched_trends_stream_equals_batch_on_closed_windows(spark, tmp_path):
    use_rocksdb(spark)
    four, five = Decimal("4.00"), Decimal("5.00")
    batches = [
        [placed(ts=0, price=four, location="TOKYO"), placed("o2", 5, item_id="i2", price=four)],
        [placed("o2", 50, item_id="i2", price=five), event("o3", ts=61, item_id="i3")],
        [event(ts=3 * 3600), event("o2", ts=3 * 3600, item_id="i2"), event(None, ts=70)],
        [event(ts=4 * 3600, item_id=None), event(ts=5 * 3600)],
        [event("o8", ts=180000), placed("o9", 180000)],
        [event("o8", ts=280000), placed("o9", 280000)],
    ]
    write_files(spark, f"{tmp_path}/in", batches, schemas.ORDER_EVENT)
    one, two = (read_files(spark, f"{tmp_path}/in", schemas.ORDER_EVENT) for _ in range(2))
    got = run_append(jobs.trends_enriched_stream(one, two, trends.ONE_DAY), str(tmp_path))
    everything = spark.createDataFrame(sum(batches, []), schemas.ORDER_EVENT)
    want = trends.trends_enriched(everything, trends.ONE_DAY).where(F.col("window_end") <= at(279990))
    found = sorted(rows(got.select(*want.columns)), key=str)
    assert found == sorted(rows(want), key=str) and len(found) == 3


INV = "skuId string, item string, eventType string, quantity bigint, event_time timestamp"
DEC = "item string, quantity bigint, event_time timestamp"


def test_turnover_stream_waits_for_the_slower_input(spark, tmp_path):
    write_files(
        spark,
        f"{tmp_path}/inv",
        [
            [("s", "X", "RESTOCK_REQUESTED_EVENT", 1, at(10))],
            [("s", "X", "OTHER_EVENT", 1, at(9000))],
        ],
        INV,
    )
    events = hub_stream(spark, f"{tmp_path}/hub", [[cancelled(ts=20)], [placed(ts=4000)]])
    restocks = stock.inventory_events(read_files(spark, f"{tmp_path}/inv", INV))
    got = run_append(jobs.turnover_stream(restocks, events), str(tmp_path))
    assert rows(got) == [("X", at(0), at(3600), 1, 1)]


def test_keyed_streams_hold_the_latest_row(spark, tmp_path):
    inv = [
        [("s1", "X", "RESTOCK_COMPLETED_EVENT", 50, at(5)), ("s2", "Y", "ODD", 1, at(6))],
        [("s1", "X", "RESTOCK_REQUESTED_EVENT", 70, at(9))],
        [("s1", "X", "RESTOCK_COMPLETED_EVENT", 10, at(1))],
    ]
    dec = [[("X", 49, at(7))], [("Z", 3, at(1))]]
    write_files(spark, f"{tmp_path}/inv", inv, INV)
    write_files(spark, f"{tmp_path}/dec", dec, DEC)
    current = run_keyed(
        jobs.stock_current_stream(read_files(spark, f"{tmp_path}/inv", INV)),
        f"{tmp_path}/a",
        ["sku_id"],
    )
    all_inv = spark.createDataFrame(sum(inv, []), INV)
    assert sorted(rows(current)) == sorted(rows(stock.stock_current(all_inv)))
    quantity = run_keyed(
        jobs.stock_quantity_stream(
            read_files(spark, f"{tmp_path}/inv", INV), read_files(spark, f"{tmp_path}/dec", DEC)
        ),
        f"{tmp_path}/b",
        ["item"],
    )
    assert sorted(rows(quantity)) == [("X", 49, at(7)), ("Z", 3, at(1))]


def test_stockout_risk_streams(spark, tmp_path):
    batches = [[cancelled(ts=5)], [cancelled(ts=4000), event(ts=1)], [placed(ts=9000)]]
    events = hub_stream(spark, f"{tmp_path}/in", batches)
    now = run_keyed(jobs.stockout_risk_current_stream(events), f"{tmp_path}/a", ["item"])
    assert rows(now) == [("X", True, at(4000))]
    hourly = run_append(jobs.stockout_risk_hourly_stream(events), f"{tmp_path}/b")
    everything = spark.createDataFrame(sum(batches, []), schemas.ORDER_EVENT)
    assert sorted(rows(hourly)) == sorted(rows(turnover.stockout_risk_hourly(everything)))


def test_customer_streams_equal_batch(spark, tmp_path):
    batches = [
        [placed("o1", 0, loyalty="L1", location="TOKYO"), placed("o1", 0, item_id="i2")],
        [placed("o2", 10), placed("o3", 5, name="Bob", loyalty="")],
        [placed("o1", 0, item_id="i3"), placed("o4", 3, name="")],
    ]
    events = hub_stream(spark, f"{tmp_path}/in", batches)
    key = ["customer_name"]
    got = jobs.customer_profile(
        run_keyed(jobs.customer_last_seen_stream(events), f"{tmp_path}/a", key),
        run_keyed(jobs.customer_order_count_stream(events), f"{tmp_path}/b", key),
    )
    everything = spark.createDataFrame(sum(batches, []), schemas.ORDER_EVENT)
    want = customer.customer_360_current(everything, with_updated_at=False)
    assert sorted(rows(got)) == sorted(rows(want))


def test_lead_time_stream_equals_batch(spark, tmp_path):
    def change(status, ts, item_id, line="QDCA10"):
        return event(status=status, ts=ts, item_id=item_id, line=line)

    batches = [
        [change("FULFILLED", 25, "a"), change("PLACED", 0, "a"), change("PLACED", 3, "b")],
        [change("IN_PROGRESS", 9, "b"), change("PLACED", 5, None), change("PLACED", 6, "c")],
        [change("FULFILLED", 40, "b"), change("FULFILLED", 41, None), cancelled(ts=20, item_id="c")],
        [change("FULFILLED", 60, "c"), change("PLACED", 61, "d", "QDCA10PRO")],
        [change("FULFILLED", 70, "d", "QDCA10PRO"), placed(ts=150, item_id="z")],
        [placed(ts=400, item_id="z")],
        [placed(ts=401, item_id="z")],
    ]
    stream = hub_stream(spark, f"{tmp_path}/in", batches)
    with state_in_rocksdb(spark):
        got = run_append(lead_time_stream(stream), str(tmp_path))
    everything = spark.createDataFrame(sum(batches, []), schemas.ORDER_EVENT)
    want = pattern.lead_times(everything)
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)
    assert want.count() == 4


def test_lead_time_stream_can_be_stopped_and_started_anywhere(spark, tmp_path):
    """Shuffled within the delay, one file at a time, each in a run of its own."""
    rng = random.Random(5)
    kinds = ["PLACED", "PLACED", "IN_PROGRESS", "FULFILLED", "FULFILLED", "CANCELLED"]
    events = [
        event(
            status=rng.choice(kinds),
            ts=t,
            item_id=rng.choice(["a", "b", None]),
            line=rng.choice(["QDCA10", "QDCA10", "QDCA10PRO"]),
        )
        for t in range(120)
    ]
    batches = [events[i : i + 24] for i in range(0, 120, 24)]
    for part in batches:
        rng.shuffle(part)
    late = [event(ts=3, status="PLACED", item_id="a")]
    batches += [[placed(ts=500, item_id="z")], late, [placed(ts=900, item_id="z")]]
    folder = f"{tmp_path}/in"
    for n in range(1, len(batches) + 1):
        stream = hub_stream(spark, folder, batches[:n])
        with state_in_rocksdb(spark):
            got = run_append(lead_time_stream(stream), str(tmp_path))
    want = pattern.lead_times(spark.createDataFrame(events, schemas.ORDER_EVENT))
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str) and want.count() > 5


def test_a_batch_changes_the_state_of_its_own_items_only(spark, tmp_path):
    """With many items in assembly a batch of one row stores a few rows, not all of them."""
    first = [event(status="PLACED", ts=0, item_id=f"i{n}") for n in range(2000)]
    batches = [first, [event(status="PLACED", ts=100, item_id="x")], [event(status="FULFILLED", ts=101, item_id="i7")]]
    batches += [[event(status="PLACED", ts=500 + n, item_id="y")] for n in range(3)]
    with state_in_rocksdb(spark):
        q = lake.append_stream(
            lead_time_stream(hub_stream(spark, f"{tmp_path}/in", batches)),
            f"{tmp_path}/out", f"{tmp_path}/ck", (), {"availableNow": True},
        )
        q.awaitTermination()
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["stateOperators"]]
    assert max(updated) >= 2000 and min(updated) < 20
    got = spark.read.schema(T.StructType(lead_time_stream(hub_stream(spark, f"{tmp_path}/in", batches)).schema.fields))
    assert [r.item_id for r in got.parquet(f"{tmp_path}/out").collect()] == ["i7"]


def test_rows_at_one_time_follow_the_life_cycle():
    due = [(5, 2, "o", "X", "L"), (5, 0, "o", "X", "L"), (5, 1, None, "X", "L"), (5, 3, None, None, None)]
    steps = (pattern.PLACED, pattern.IN_PROGRESS, pattern.FULFILLED)
    start, found = follow(None, sorted(due, key=in_order), steps)
    assert start is None and found == [((5, "o", "X", "L", 1), 5)]
    assert follow((1, "o", "X", "L", 1), [(2, 1, "o", "X", "L")], steps) == (None, [])
    assert follow((1, "o", "X", "L", 0), [(2, 2, "o", "X", "M")], steps) == (None, [])


def test_customer_profile_is_one_stream(spark, tmp_path):
    batches = [
        [placed("o1", 0, loyalty="L1", location="TOKYO"), placed("o1", 0, item_id="i2")],
        [placed("o2", 10), placed("o3", 5, name="Bob", loyalty="")],
        [placed("o1", 0, item_id="i3"), placed("o4", 3, name=""), placed("o0", 10)],
    ]
    stream = customer_profile_stream(hub_stream(spark, f"{tmp_path}/in", batches))
    with state_in_rocksdb(spark):
        got = run_keyed(stream, str(tmp_path), ["customerName"])
    everything = spark.createDataFrame(sum(batches, []), schemas.ORDER_EVENT)
    want = customer.customer_360_current(everything, with_updated_at=False)
    assert sorted(rows(got.drop("updatedAt"))) == sorted(rows(want.select(*got.columns[:-1])))
    assert got.where("updatedAt IS NULL").count() == 0
    assert contracts.violations(got, contracts.CUSTOMER_PROFILE).count() == 0


def test_state_settings_are_back_afterwards(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.unset("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
    with pytest.raises(KeyError), state_in_rocksdb(spark):
        assert "RocksDB" in spark.conf.get(name)
        raise KeyError
    assert spark.conf.get(name) == before


def test_readers_see_a_batch_in_all_targets_or_in_none(spark, tmp_path):
    """A writer that dies between two targets leaves nothing to see; the next run repairs it."""
    dies = {"at": 1}

    def second(batch):
        if dies.get("at") == batch.agg(F.max("n")).first()[0]:
            raise RuntimeError("killed")
        return batch.select((F.col("n") * 10).alias("ten"))

    targets = [Target("one", lambda b: b), Target("two", second)]
    write_files(spark, f"{tmp_path}/in", [[(0,)], [(1,)], [(2,)]], "n long")
    stream = read_files(spark, f"{tmp_path}/in", T.StructType().add("n", "long"))
    path, checkpoint, now = f"{tmp_path}/set", f"{tmp_path}/ck", {"availableNow": True}

    def seen():
        one = read_target(spark, path, "one", T.StructType().add("n", "long"))
        two = read_target(spark, path, "two", T.StructType().add("ten", "long"))
        return sorted(rows(one)), sorted(rows(two))

    assert newest_mark(spark, path) is None and seen() == ([], [])
    with pytest.raises(Exception, match="killed"):
        set_stream(stream, path, checkpoint, targets, now).awaitTermination()
    assert os.path.exists(f"{path}/one/batch_id=1") and not os.path.exists(f"{path}/two/batch_id=1")
    assert seen() == ([(0,)], [(0,)])
    dies.clear()
    set_stream(stream, path, checkpoint, targets, now).awaitTermination()
    assert seen() == ([(0,), (1,), (2,)], [(0,), (10,), (20,)])
    # a batch whose mark was written, but which Spark repeats, is not written again
    write_set(path, targets)(spark.createDataFrame([(9,)], "n long"), 2)
    assert seen()[0] == [(0,), (1,), (2,)] and os.listdir(f"{path}/_complete") in (["2"], [".2.crc", "2"], ["2", ".2.crc"])


def test_files_of_a_set_are_sized_and_a_repeated_batch_replaces_its_own(spark, tmp_path):
    values = [("hot", n) for n in range(1000)] + [(f"k{n % 5}", n) for n in range(50)]
    batch = spark.createDataFrame(values, "kind string, n long").repartition(16)
    target = Target("out", lambda b: b, [lake.identity("kind")], rows_per_file=100)
    write = write_set(str(tmp_path), [target])

    def files(kind="*", batch_id="*"):
        return glob.glob(f"{tmp_path}/out/batch_id={batch_id}/kind={kind}/*.parquet")

    write(batch, 0)
    assert len(files("hot")) > 5 and len(files()) <= 1050 / 100 + 1 + 6
    for name in os.listdir(f"{tmp_path}/_complete"):  # stopped before its mark
        os.remove(f"{tmp_path}/_complete/{name}")
    write(batch, 0)
    write(batch.limit(30), 1)
    assert len(files(batch_id=1)) <= 6
    got = read_target(spark, str(tmp_path), "out", batch.schema, target.transforms)
    assert got.columns == ["kind", "n"] and got.count() == 1080
    assert sorted(rows(got.distinct())) == sorted(values)


def test_groups_dropped_as_late_are_counted(spark, tmp_path):
    """A batch's late rows are judged by the mark that held when the batch before it began."""
    batches = [[event(ts=0)], [event(ts=5000)], [event(ts=10)], [event(ts=20), event(ts=6000)], [event(ts=9000)]]
    stream = jobs.trends_stream(hub_stream(spark, f"{tmp_path}/in", batches), trends.FIVE_MINUTES)
    table, figures = replay_measured(spark, stream)
    found = {r.batch: (r.rows_read, r.groups_dropped) for r in figures.collect()}
    assert found == {0: (1, 0), 1: (1, 0), 2: (1, 0), 3: (2, 1), 4: (1, 0)}
    assert sum(r.order_count for r in table.collect()) == 4  # the newest window is still open


def test_bad_json_goes_to_a_side_table_with_its_reason(spark, tmp_path):
    good = '{"skuId":"s","item":"X","eventType":"R","quantity":4}'
    values = [
        good, "plain", "", None, "[1]", '"text"', '{"skuId":"s","quantity":"many"}', '{"quantity":null}',
        '{"skuId":{"a":1},"item":7}', "{broken",
    ]
    schema = "value string, timestamp timestamp"
    write_files(spark, f"{tmp_path}/in", [[(v, at(n))] for n, v in enumerate(values)], schema)
    checked = topics.check_json(topics.file_topic(spark, f"{tmp_path}/in"), schemas.INVENTORY_OUT)
    targets = [Target("records", topics.accepted), Target("quarantine", topics.quarantined)]
    path = f"{tmp_path}/set"
    set_stream(checked, path, f"{tmp_path}/ck", targets, {"availableNow": True}).awaitTermination()
    kept, bad = (read_target(spark, path, t.name, t.rows(checked).schema) for t in targets)
    lenient = topics.decode_json(spark.createDataFrame([(v, at(n)) for n, v in enumerate(values)], schema), schemas.INVENTORY_OUT, True)
    assert sorted(rows(kept), key=str) == sorted(rows(lenient), key=str)
    reasons = {r.value: r.reason for r in bad.collect()}
    broken = {v: "not_an_object" for v in ("plain", "", None, "[1]", '"text"', "{broken")}
    assert reasons == broken | {'{"skuId":"s","quantity":"many"}': "wrong_type:quantity"}
    strict = topics.decode_json(topics.file_topic(spark, f"{tmp_path}/in"), schemas.INVENTORY_OUT)
    q = strict.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ck2").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="(?i)malformed|parse|failfast"):
        q.awaitTermination()


def test_restart_and_replay_change_nothing(spark, tmp_path):
    folder = f"{tmp_path}/in"
    first = [[event(ts=0)], [event(ts=400)]]
    stream = jobs.trends_stream(hub_stream(spark, folder, first), trends.FIVE_MINUTES)
    run_append(stream, str(tmp_path))
    again = run_append(stream, str(tmp_path))
    assert again.count() == 1
    write_files(spark, folder, first + [[event(ts=800)], [event(ts=1200)]], schemas.ORDER_EVENT)
    assert run_append(stream, str(tmp_path)).count() == 3


def test_repeated_batch_replaces_itself(spark, tmp_path):
    schema = "item string, quantity bigint"
    write = keyed.write_batch(str(tmp_path))
    write(spark.createDataFrame([("X", 1), ("Y", 1)], schema), 0)
    write(spark.createDataFrame([("X", 2)], schema), 1)
    write(spark.createDataFrame([("X", 2)], schema), 1)
    fields = T.StructType.fromDDL(schema)
    want = [("X", 2), ("Y", 1)]
    assert sorted(rows(keyed.read_latest(spark, str(tmp_path), ["item"], fields))) == want
    for _ in range(2):  # repeating it changes nothing
        keyed.compact(spark, str(tmp_path), ["item"], fields, 1)
        assert sorted(rows(keyed.read_latest(spark, str(tmp_path), ["item"], fields))) == want
    write(spark.createDataFrame([("Y", 9)], schema), 2)
    latest = keyed.read_latest(spark, str(tmp_path), ["item"], fields)
    assert sorted(rows(latest)) == [("X", 2), ("Y", 9)]


def test_keyed_table_stays_small_and_survives_a_broken_compaction(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "item string, quantity bigint"
    fields, want = T.StructType.fromDDL(schema), {}
    write = keyed.write_batch(path)
    for n in range(30):
        want |= {f"i{n % 7}": n, "same": -n}
        changed = [(f"i{n % 7}", n), ("same", -n)]
        write(spark.createDataFrame(changed, schema).coalesce(1), n)
        if n == 20:  # a compaction that broke off has no success mark and doesn't count
            os.makedirs(f"{path}_base/batch_id=20")
        if n % 5 == 4:
            keyed.compact(spark, path, ["item"], fields, n)
            assert dict(rows(keyed.read_latest(spark, path, ["item"], fields))) == want
    assert sorted(os.listdir(path)) == [f"batch_id={n}" for n in range(25, 30)]
    bases = [b for b in os.listdir(f"{path}_base") if os.listdir(f"{path}_base/{b}")]
    assert sorted(bases) == ["batch_id=24", "batch_id=29"]


def test_one_batch_feeds_several_targets(spark, tmp_path):
    stream = jobs.stockout_risk_current_stream(
        hub_stream(spark, f"{tmp_path}/in", [[cancelled(ts=5)], [cancelled(ts=6)]])
    )
    records = []

    def publish(batch, batch_id):
        records.extend(r["value"] for r in topics.to_keyed_records(batch, "item").collect())

    q = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", f"{tmp_path}/ck")
        .trigger(availableNow=True)
        .foreachBatch(keyed.fan_out(publish, keyed.write_batch(f"{tmp_path}/out")))
        .start()
    )
    q.awaitTermination()
    assert [json.loads(r)["item"] for r in records] == ["X", "X"]
    fields = T.StructType(stream.schema.fields)
    latest = keyed.read_latest(spark, f"{tmp_path}/out", ["item"], fields)
    assert rows(latest) == [("X", True, at(6))]


def test_raw_topic_files_decode_as_a_stream(spark, tmp_path):
    batches = [[('{"item":"X","quantity":1}', at(0)), ("junk", at(1))]]
    write_files(spark, f"{tmp_path}/in", batches, topics.TOPIC_FILE_SCHEMA)
    topic = topics.file_topic(spark, f"{tmp_path}/in", files_per_batch=1)
    decoded = topics.decode_json(topic, schemas.STOCK_DECREMENT, lenient=True)
    assert rows(run_append(decoded, str(tmp_path))) == [("X", 1, at(0))]


@pytest.mark.parametrize("kind", ["day", "month", "identity"])
def test_partition_pruning(spark, tmp_path, kind):
    df = spark.createDataFrame(
        [("a", at(0)), ("b", at(86400)), ("c", at(40 * 86400))], "event_type string, ts timestamp"
    )
    transform = {
        "day": lake.day("ts"),
        "month": lake.month("ts"),
        "identity": lake.identity("event_type"),
    }[kind]
    lake.append(df, f"{tmp_path}/t", [transform])
    lake.append(df, f"{tmp_path}/t", [transform])
    stored = lake.read(spark, f"{tmp_path}/t", df.schema, [transform])
    assert stored.count() == 6 and stored.columns == df.columns
    low, high, count = {
        "day": ("2024-03-02", "2024-03-31", 2),
        "month": ("2024-03", "2024-03", 4),
        "identity": ("b", "c", 4),
    }[kind]
    pruned = lake.read_days(spark, f"{tmp_path}/t", df.schema, [transform], low, high)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == count and f"PartitionFilters: [isnotnull({transform.column}" in plan


def test_identity_partitions_keep_their_type(spark, tmp_path):
    df = spark.createDataFrame([("007", 1), ("2024-01-01", 2)], "code string, n int")
    by_code = [lake.identity("code")]
    lake.append(df, f"{tmp_path}/t", by_code)
    assert sorted(rows(lake.read(spark, f"{tmp_path}/t", df.schema, by_code))) == sorted(rows(df))
    found = lake.read_days(spark, f"{tmp_path}/t", df.schema, by_code, "007", "007")
    assert rows(found) == [("007", 1)]


def test_cuts_of_several_files_are_one_batch_each(spark, tmp_path):
    """Unequal cuts, one of them empty: every micro-batch still reads one cut."""
    rows_ = [(i, at(s)) for i, s in enumerate([0] * 50 + [25] * 3 + [35] * 11)]
    df = spark.createDataFrame(rows_, "i int, ts timestamp")
    path, files = replayed.write_cut(df, "ts", at(0), at(40), cuts=4, rows_per_file=10)
    assert files == 5
    seen = []
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)
    query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/ck").foreachBatch(
        lambda batch, _: seen.append((batch.count(), batch.select("ts").distinct().count()))
    )
    query.trigger(availableNow=True).start().awaitTermination()
    assert seen == [(50, 1), (0, 0), (3, 1), (11, 1)]
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 10 + 8  # each of up to eight tasks deals its own rows, starting anywhere


def test_an_idle_source_holds_windows_back(spark, tmp_path):
    """The stock topic is silent: no hour is over, whatever the cancellations say. After a restart
    Spark knows a source's mark only once it has sent rows again, so both do here."""
    use_slowest(spark)
    write_files(spark, f"{tmp_path}/inv", [[("s", "X", "RESTOCK_REQUESTED_EVENT", 1, at(10))]], INV)
    sent = [[cancelled(ts=20)], [cancelled(ts=90_000)]]
    events = hub_stream(spark, f"{tmp_path}/hub", sent)
    restocks = stock.inventory_events(read_files(spark, f"{tmp_path}/inv", INV))
    stream = jobs.turnover_stream(restocks, events)
    assert rows(run_append(stream, str(tmp_path))) == []
    write_files(spark, f"{tmp_path}/hub", [*sent, [placed(ts=90_001)]], schemas.ORDER_EVENT)
    spark.createDataFrame([("s", "Y", "OTHER_EVENT", 1, at(9000))], INV).select(
        F.to_json(F.struct("*")).alias("value")
    ).write.mode("append").text(f"{tmp_path}/inv")
    assert rows(run_append(stream, str(tmp_path))) == [("X", at(0), at(3600), 1, 1)]


def test_raw_topics_carry_a_watermark_of_their_own(spark, tmp_path):
    """Two raw topics, one of them without rows: the watermark of the query doesn't move."""
    use_slowest(spark)
    write_files(spark, f"{tmp_path}/inv", [[("s", "X", "RESTOCK_COMPLETED_EVENT", 1, at(10))]], INV)
    write_files(spark, f"{tmp_path}/dec", [[("X", 49, at(7))]], DEC)
    os.makedirs(f"{tmp_path}/none")

    def marks(dec):
        reports = jobs.stock_quantity_stream(
            jobs.raw(read_files(spark, f"{tmp_path}/inv", INV)), jobs.raw(read_files(spark, f"{tmp_path}/{dec}", DEC))
        )
        out = f"{tmp_path}/{dec}-out"
        q = keyed.upsert_stream(reports, f"{out}/t", f"{out}/ck", {"availableNow": True})
        q.awaitTermination()
        return [p.eventTime.get("watermark") for p in q.recentProgress]

    assert marks("none")[-1].startswith("1970-01-01T00:00:00")
    assert marks("dec")[-1].startswith(at(2).isoformat())


def test_consumers_of_a_stored_hub_read_each_event_once(spark, tmp_path):
    def store_hub(batches):
        events = hub_stream(spark, f"{tmp_path}/in", batches)
        run_append(events, f"{tmp_path}/hub", by_type)
        return lake.read_stream(spark, f"{tmp_path}/hub/out", events.schema, by_type)

    by_type = [lake.identity("eventType")]
    first, second = [event(ts=1), placed(ts=2)], [event(ts=3, order="o2"), placed(ts=4000)]
    run_append(jobs.trends_stream(store_hub([first]), trends.FIVE_MINUTES), str(tmp_path))
    stored = store_hub([first, second])
    got = run_append(jobs.trends_stream(stored, trends.FIVE_MINUTES), str(tmp_path))
    assert [(r.item, r.order_count) for r in got.collect()] == [("X", 2)]


def test_figures_of_ended_queries(spark):
    with ended_queries() as ended:
        items = registry.queries()["stock_quantity_stream"](spark, "/root/testdata/sf0.001").count()
    found = summary(ended)
    topics_ = (testdata.inventory_out, testdata.stock_decrement)
    assert found["rows"] == sum(t(spark, "/root/testdata/sf0.001").count() for t in topics_)
    assert found["rows_per_sec"] > 0 and found["state_rows"] == items > 0 and found["late_groups"] == 0


def test_topics_are_cut_at_the_same_times(spark, tmp_path):
    """Eight micro-batches, of both topics the same stretch of event time, in order."""
    spans = {}
    for name in ("inventory_out", "stock_decrement"):
        seen = []

        def note(batch, batch_id, seen=seen):
            seen.append(batch.agg(F.min("event_time"), F.max("event_time"), F.count("*")).first())

        topic = getattr(testdata, name)
        stream = topic(spark, "/root/testdata/sf0.001", stream=True)
        query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/{name}").foreachBatch(note)
        query.trigger(availableNow=True).start().awaitTermination()
        assert len(seen) == 8 and sum(r[2] for r in seen) == topic(spark, "/root/testdata/sf0.001").count()
        spans[name] = seen
    stretches = list(zip(*spans.values(), strict=True))
    for now, later in itertools.pairwise(stretches):
        assert max(r[1] for r in now) < min(r[0] for r in later)


def test_a_batch_adds_one_file_to_a_day_and_few_state_partitions(spark, tmp_path):
    """Not a file for each task and day, nor state partitions that outnumber the cores many times."""
    df = spark.range(64).selectExpr("id", "timestamp'2024-03-01' + make_interval(0, 0, 0, id % 2) AS ts")
    df.repartition(8).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    assert run_append(stream, str(tmp_path / "a"), [lake.day("ts")]).count() == 64
    assert len(glob.glob(f"{tmp_path}/a/out/ts_day=*/*.parquet")) == 2
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        counted = run_keyed(stream.groupBy("id").count(), str(tmp_path / "b"), ["id"])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert counted.count() == 64
    assert len(glob.glob(f"{tmp_path}/b/ck/state/0/*")) <= 17


def test_targets_of_a_set_are_written_at_the_same_time(spark, tmp_path):
    """Each target waits for the other to begin."""
    meet = threading.Barrier(2, timeout=60)

    def rows_of(batch):
        meet.wait()
        return batch

    write_set(str(tmp_path), [Target(n, rows_of) for n in ("one", "two")])(spark.range(10), 0)
    for name in ("one", "two"):
        assert read_target(spark, str(tmp_path), name, spark.range(1).schema).count() == 10


def test_many_keys_take_few_state_rows(spark, tmp_path):
    """Customers share buckets of state: 3000 of them in one batch are far fewer rows of it."""
    batches = [[placed(f"o{n}", n % 60, name=f"c{n}") for n in range(3000)], [placed("o1", 3, name="c1")]]
    stream = customer_profile_stream(hub_stream(spark, f"{tmp_path}/in", batches))
    with state_in_rocksdb(spark):
        q = keyed.upsert_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ck", {"availableNow": True})
        q.awaitTermination()
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["stateOperators"]]
    assert max(updated) <= 2 * segments.BUCKETS and min(updated) <= 2
    got = keyed.read_latest(spark, f"{tmp_path}/out", ["customerName"], T.StructType(stream.schema.fields))
    assert got.count() == 3000 and got.where("totalOrders = 1").count() == 3000


def test_topic_rows_are_written_once(spark, tmp_path, monkeypatch):
    """The files that tasks write are the cuts' files, several where a cut has many rows; cuts with
    fewer get empty ones. Nothing reads and writes the rows again."""
    monkeypatch.setattr(replayed, "ROWS_PER_FILE", 10)
    monkeypatch.setattr(replayed, "_dealt", None)
    rows_ = [(i, at(s)) for i, s in enumerate([0] * 50 + [25] * 3 + [35] * 11)]
    df = spark.createDataFrame(rows_, "i int, ts timestamp").coalesce(1)
    path, files = replayed.write_cut(df, "ts", at(0), at(40), cuts=4)
    assert files == 5 and len(glob.glob(f"{path.removeprefix('file:')}/*.parquet")) == 20
    seen = []
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)
    query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/ck").foreachBatch(
        lambda batch, _: seen.append(sorted(r.i for r in batch.collect()))
    )
    query.trigger(availableNow=True).start().awaitTermination()
    assert seen == [list(range(50)), [], [50, 51, 52], list(range(53, 64))]


def test_the_two_streams_of_the_profile_keep_their_state_on_disk(spark, monkeypatch):
    """A state row for each order doesn't stay in memory, to be copied by each batch."""
    from orderloom.plans import registry

    name, used = "spark.sql.streaming.stateStore.providerClass", []

    def replayed_rows(session, stream, keys):
        used.append(session.conf.get(name, ""))
        return session.createDataFrame([], stream.schema)

    monkeypatch.setattr(registry, "replay_keyed", replayed_rows)
    before = spark.conf.get(name, None)
    registry._customer_360_stream(spark, "/root/testdata/sf0.001")
    assert len(used) == 2 and all(u.endswith("RocksDBStateStoreProvider") for u in used)
    assert spark.conf.get(name, None) == before


def test_lines_meet_their_parts_before_their_orders(spark):
    """Where no side is small enough to be broadcast, the lines that move to their parts are narrow."""
    sf = "/root/testdata/sf0.001"
    topics_of_lines = (testdata.orders_in, testdata.orders_up, testdata.eighty_six, testdata.item_status_events)
    for topic in topics_of_lines:
        plan = topic(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line]
        assert "l_orderkey" in joins[0] and any("l_partkey" in line for line in joins[1:]), joins


def shuffle_files():
    root = os.environ.get("SPARK_LOCAL_DIRS") or tempfile.gettempdir()
    return set(Path(root).glob("**/blockmgr-*/*/shuffle_*.data"))


def test_a_stream_keeps_its_rows_small_and_no_shuffle_files(spark, tmp_path):
    """Of a topic, an appended table and a set only the stored rows stay on disk, and ids that are
    hashes take half of their text."""
    held = spark.range(4000, numPartitions=3).select(
        F.sha2(F.col("id").cast("string"), 256).alias("eventId"),
        F.concat(F.lit("k"), F.col("id") % 3).alias("kind"),
        (F.lit(at(0)) + F.make_dt_interval(secs=F.col("id") * 10)).alias("ts"),
    )
    before = shuffle_files()
    path, files = replayed.write_cut(held.repartition(5, "kind"), "ts", at(0), at(40_000), cuts=2)
    stream = spark.readStream.schema(held.schema).option("maxFilesPerTrigger", files).parquet(path)
    out = run_append(stream, f"{tmp_path}/lake", [lake.day("ts"), lake.identity("kind")])
    targets = [Target("one", lambda b: b, [lake.identity("kind")], rows_per_file=500)]
    set_stream(stream, f"{tmp_path}/set", f"{tmp_path}/ck", targets, {"availableNow": True}).awaitTermination()
    for _ in range(50):  # files go in the background
        if not shuffle_files() - before:
            break
        time.sleep(0.1)
    assert not shuffle_files() - before
    one = read_target(spark, f"{tmp_path}/set", "one", held.schema, targets[0].transforms)
    assert sorted(rows(held)) == sorted(rows(out.select(held.columns))) == sorted(rows(one))
    for folder in (path.removeprefix("file:"), f"{tmp_path}/lake/out", f"{tmp_path}/set"):
        found = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)]
        columns = [m.row_group(0).column(0) for m in found if m.num_rows]
        assert columns and {c.compression for c in columns} == {"ZSTD"}
        assert sum(c.total_compressed_size for c in columns) < 0.7 * 64 * 4000
