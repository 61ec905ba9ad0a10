"""Lake tables and the public views over them.

Tables live in one database; each product publishes its views in a database of
its own, which is all that consumers are given. Derived partition columns belong
to the tables and do not show in the views.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderloom.sinks.lake import Transform, day, identity, month, partitioned


@dataclass(frozen=True)
class LakeTable:
    columns: str
    layout: tuple[Transform, ...] = ()

    def ddl(self, name: str) -> str:
        derived = "".join(
            f", {t.column} {'date' if t.kind == 'day' else 'string'}"
            for t in self.layout
            if t.kind != "identity"
        )
        by = ", ".join(t.column for t in self.layout)
        tail = f" PARTITIONED BY ({by})" if by else ""
        return f"CREATE TABLE IF NOT EXISTS {name} ({self.columns}{derived}) USING parquet{tail}"

    def names(self) -> list[str]:
        return T.StructType.fromDDL(self.columns).names


_TREND = (
    "item string, window_start timestamp, window_end timestamp, order_count bigint, "
    "revenue decimal(12,2), assembly_line string, location string"
)
_LEAD_TIME = (
    "item_id string, order_id string, item string, placed_at timestamp, "
    "fulfilled_at timestamp, lead_time_seconds bigint, assembly_line string"
)

# --- fixed values: table and view names, columns and partitioning -------------
TABLES = {
    "order_events_history": LakeTable(
        "event_id string, order_id string, event_type string, event_timestamp timestamp, "
        "order_source string, location string, loyalty_member_id string, order_status string, "
        "line_item_id string, line_item_name string, line_item_price decimal(10,2), "
        "line_item_status string, assembly_line string, source_domain string, "
        "source_topic string",
        (day("event_timestamp"), identity("event_type")),
    ),
    "order_events_current": LakeTable(
        "order_id string, order_status string, order_source string, location string, "
        "loyalty_member_id string, placed_at timestamp, last_updated_at timestamp, "
        "assembly_line string",
        (identity("location"),),
    ),
    "sales_trends_5m": LakeTable(_TREND, (day("window_start"),)),
    "sales_trends_daily": LakeTable(_TREND, (month("window_start"),)),
    "component_stock_events": LakeTable(
        "event_id string, sku_id string, item string, event_type string, "
        "event_timestamp timestamp, source_topic string",
        (day("event_timestamp"),),
    ),
    "component_stock_current": LakeTable(
        "sku_id string, item string, latest_status string, last_event_at timestamp"
    ),
    "component_stock_quantity": LakeTable(
        "item string, quantity bigint, last_restocked_at timestamp"
    ),
    "inventory_turnover": LakeTable(
        "item string, window_start timestamp, window_end timestamp, "
        "restock_requested_count bigint, stockout_cancelled_count bigint",
        (day("window_start"),),
    ),
    "stockout_risk": LakeTable("item string, at_risk boolean, last_stockout_event_at timestamp"),
    "qdca10_lead_time": LakeTable(_LEAD_TIME, (day("fulfilled_at"),)),
    "qdca10pro_lead_time": LakeTable(_LEAD_TIME, (day("fulfilled_at"),)),
    "customer_events_history": LakeTable(
        "customer_name string, loyalty_member_id string, location string, order_id string, "
        "event_timestamp timestamp",
        (day("event_timestamp"),),
    ),
}
# views that show a table as it is
PLAIN_VIEWS = {
    "order_events.orders_current": "order_events_current",
    "order_events.order_events_history": "order_events_history",
    "sales_trends.trends_5m": "sales_trends_5m",
    "sales_trends.trends_daily": "sales_trends_daily",
    "component_stock.stock_current": "component_stock_current",
    "component_stock.stock_events": "component_stock_events",
    "inventory_analytics.stockout_risk": "stockout_risk",
    "assembly_lead_time.qdca10": "qdca10_lead_time",
    "assembly_lead_time.qdca10pro": "qdca10pro_lead_time",
}
# --- end of fixed values ------------------------------------------------------

# Views that compute. One aggregation each: nothing ranks all rows of a key in one task.
COMPUTED_VIEWS = {
    "inventory_analytics.turnover": """
        SELECT item, window_start, window_end,
               sum(restock_requested_count) AS restock_requested_count,
               sum(stockout_cancelled_count) AS stockout_cancelled_count
        FROM {tables}.inventory_turnover
        GROUP BY item, window_start, window_end""",
    "assembly_lead_time.all_lines": """
        SELECT * FROM assembly_lead_time.qdca10
        UNION ALL SELECT * FROM assembly_lead_time.qdca10pro""",
    "customer_360.profile_full": """
        SELECT customer_name, newest.loyalty_member_id, newest.location AS last_location,
               newest.order_id AS last_order_id, newest.event_timestamp AS last_order_at,
               total_orders
        FROM (SELECT customer_name, count(*) AS total_orders,
                     max(struct(event_timestamp, order_id, location, loyalty_member_id)) AS newest
              FROM {tables}.customer_events_history GROUP BY customer_name)""",
    "customer_360.profile_masked": """
        SELECT concat(left(customer_name, 1), '***') AS customer_name,
               if(loyalty_member_id IS NULL, NULL, '***') AS loyalty_member_id,
               last_location, last_order_id, last_order_at, total_orders
        FROM customer_360.profile_full""",
}


def create_tables(spark: SparkSession, database: str = "dataproducts") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, lake_table in TABLES.items():
        spark.sql(lake_table.ddl(f"{database}.{name}"))


def publish_views(spark: SparkSession, database: str = "dataproducts") -> None:
    for view, name in PLAIN_VIEWS.items():
        columns = ", ".join(TABLES[name].names())
        _create_view(spark, view, f"SELECT {columns} FROM {database}.{name}")
    for view, query in COMPUTED_VIEWS.items():
        _create_view(spark, view, query.format(tables=database))


def _create_view(spark: SparkSession, view: str, query: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {view.split('.')[0]}")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")


def insert(df: DataFrame, name: str, database: str = "dataproducts") -> None:
    """Append rows to a catalogued table, deriving its partition columns."""
    lake_table = TABLES[name]
    spark = df.sparkSession
    target = spark.table(f"{database}.{name}")
    rows = partitioned(df, lake_table.layout)
    if lake_table.layout:
        rows = rows.hint("rebalance", *[t.column for t in lake_table.layout])
    rows.select(*target.columns).write.mode("append").insertInto(f"{database}.{name}")


def overwrite_current(df: DataFrame, name: str, database: str = "dataproducts") -> None:
    """Replace a table that holds one row per key, from a frame that does not read it.

    The whole table is replaced, also where the session overwrites partitions
    dynamically: a key that has moved must not stay in its old partition.
    """
    spark = df.sparkSession
    columns: Sequence[str] = spark.table(f"{database}.{name}").columns
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "static")
    try:
        df.select(*columns).write.mode("overwrite").insertInto(f"{database}.{name}")
    finally:
        spark.conf.set(setting, before)
