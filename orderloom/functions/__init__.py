"""Column helpers shared by the operators. All are built-in, code-generated expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import HOST_PREFIXES, STOCK_EVENT_CODES


def format_millis(ts: Column) -> Column:
    """Timestamp text with exactly three fraction digits, as ids need it."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def to_millis(ts: Column) -> Column:
    return F.date_trunc("MILLISECOND", ts)


def event_id(order_id: Column, item_id: Column, kind: str, ts: Column) -> Column:
    """Content hash, so a replay yields the same id. NULL in any part gives NULL."""
    return F.md5(
        F.concat(order_id, F.lit("|"), item_id, F.lit(f"|{kind}|"), format_millis(ts))
    )


def host_lookup(made_by: Column, position: int) -> Column:
    """Value for the longest matching host prefix; NULL when none matches."""
    result = None
    for prefix in sorted(HOST_PREFIXES, key=len, reverse=True):
        value = F.lit(HOST_PREFIXES[prefix][position])
        match = made_by.startswith(prefix)
        result = F.when(match, value) if result is None else result.when(match, value)
    return result


def assembly_line(made_by: Column) -> Column:
    return host_lookup(made_by, 0)


def source_domain(made_by: Column) -> Column:
    return host_lookup(made_by, 1)


def stock_event_type(raw: Column) -> Column:
    """Published code of a stock event; unknown codes pass through."""
    known = F.create_map(*[F.lit(x) for pair in STOCK_EVENT_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, raw), raw)


def null_of(data_type: str | T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def latest(ts: str, *columns: str) -> Column:
    """Struct of the newest row. Equal times fall back to the values, so any
    execution order gives the same answer. Partially aggregated before the shuffle."""
    return F.max(F.struct(ts, *columns))


def last_value(column: str, ts: str) -> Column:
    """Newest non-NULL value of ``column``."""
    present = F.col(column).isNotNull()
    return F.max(F.when(present, F.struct(ts, column))).getField(column)


def keep(df: DataFrame, condition: Column, ts: str) -> DataFrame:
    """Filter that lets every row, kept or not, advance a stream's watermark.

    Catalyst moves a filter that does not read the event time below the
    watermark operator; rows it drops would then never advance event time. On
    streams the condition is therefore tied to the event-time column. Batch
    frames use the plain condition, which still reaches the scan.
    """
    if df.isStreaming:
        return df.where(F.when(condition, F.col(ts).isNotNull()).otherwise(F.lit(False)))
    return df.where(condition)


def as_wall_time(df: DataFrame) -> DataFrame:
    """Zone-less timestamps for every TIMESTAMP column (session zone is UTC)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
