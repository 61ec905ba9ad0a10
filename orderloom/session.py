"""Session settings the library relies on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

#: State partitions of a stream for each core, and at least, if the session has as many.
STATE_PER_CORE, LEAST_STATE = 2, 16
#: Codec of stored rows. Ids that are hashes as text only get smaller where single characters are coded.
CODEC = "zstd"

_own_dir: str | None = None


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: daily windows and ids are defined on UTC wall time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_slowest(spark: SparkSession) -> SparkSession:
    """Of several watermarks in a query the slowest counts, so no source's rows become late
    because another one is ahead."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    return spark


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Keep streaming state in RocksDB: on local disk, not in memory, and with timers."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[SparkSession]:
    """The session with other settings, ``spark.sql.`` before their names (``__`` for a dot).
    Its own are back afterwards."""
    values = {f"spark.sql.{name.replace('__', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[SparkSession]:
    """The shuffle files of each query that is run inside go when it ends, not when the driver's
    garbage collector finds out. A frame must not be collected twice inside. Those of a stream
    that is started inside go with each batch."""
    return settings(spark, classic__shuffleDependency__fileCleanup__enabled="true")


def state_in_rocksdb(spark: SparkSession) -> AbstractContextManager[SparkSession]:
    """Queries started inside keep their state in RocksDB, and each batch stores its changes
    only. The session's own settings are back afterwards."""
    return settings(
        spark,
        streaming__stateStore__providerClass=(
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
    )


def state_by_cores(spark: SparkSession) -> AbstractContextManager[SparkSession]:
    """Queries started inside have at most ``STATE_PER_CORE`` state partitions a core. Each batch
    opens and stores every one, so with few rows in each these would take most of the time."""
    few = max(LEAST_STATE, STATE_PER_CORE * spark.sparkContext.defaultParallelism)
    return settings(spark, shuffle__partitions=str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), few)))


def shared_dir(spark: SparkSession, purpose: str, name: str | None = None) -> str:
    """A folder every executor can reach, under ``spark.checkpoint.dir``.

    Without a ``name`` each call gets a fresh folder. A temporary folder is
    used only where the cluster names none, as in local tests.
    """
    global _own_dir
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _own_dir = _own_dir or tempfile.mkdtemp(prefix="orderloom-")
        root = _own_dir
    return f"{root.rstrip('/')}/orderloom/{purpose}/{name or uuid.uuid4().hex}"
