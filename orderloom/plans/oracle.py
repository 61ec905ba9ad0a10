"""The same results in DuckDB SQL, written independently of the Spark operators."""

from __future__ import annotations

# Raw topics derived from the test tables.
_LINES = """
li AS (
  SELECT l.*, p_brand, c_name, o_custkey, c_acctbal, n_regionkey, o_orderkey,
         l_orderkey::VARCHAR AS order_id,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS item_id,
         o_orderdate + to_seconds(o_orderkey % 86400) AS t,
         o_orderdate + to_seconds(o_orderkey % 86400)
           + to_seconds((l_linenumber - 1) * CASE WHEN l_orderkey % 3 = 0 THEN 9 ELSE 2 END) AS pt,
         CASE WHEN l_suppkey % 13 = 0 THEN NULL
              WHEN l_suppkey % 11 = 0 THEN 'other-' || l_suppkey
              WHEN l_suppkey % 2 = 0 THEN 'qdca10-' || l_suppkey
              ELSE 'qdca10pro-' || l_suppkey END AS made_by
  FROM lineitem l
  JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN part ON p_partkey = l_partkey)"""

_PLACED = """
placed AS (
  SELECT md5(order_id || '|' || item_id || '|ORDER_PLACED|' || strftime(pt, '%Y-%m-%d %H:%M:%S.%g'))
           AS "eventId",
         order_id AS "orderId", 'ORDER_PLACED' AS "eventType", pt AS "eventTimestamp",
         CASE o_orderkey % 3 WHEN 0 THEN 'COUNTER' WHEN 1 THEN 'WEB' ELSE 'PARTNER' END
           AS "orderSource",
         CASE n_regionkey WHEN 0 THEN 'ATLANTA' WHEN 1 THEN 'CHARLOTTE' WHEN 2 THEN 'RALEIGH'
           WHEN 3 THEN 'TOKYO' END AS location,
         CASE WHEN c_acctbal > 0 AND o_orderkey % 2 = 0 THEN 'L' || o_custkey
              WHEN o_orderkey % 10 = 1 THEN '' END AS "loyaltyMemberId",
         'PLACED' AS "orderStatus", item_id AS "itemId", p_brand AS item, c_name AS name,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price, 'PLACED' AS "lineItemStatus",
         CASE WHEN l_suppkey % 2 = 0 THEN 'QDCA10' ELSE 'QDCA10PRO' END AS "assemblyLine",
         NULL::VARCHAR AS "madeBy", 'counter' AS "sourceDomain", 'orders-in' AS "sourceTopic"
  FROM li)"""

_STATUS = """
up AS (SELECT *, t + to_seconds(60 * CAST(l_quantity AS INT)) AS up_t FROM li
       WHERE l_linestatus = 'F'),
status AS (
  SELECT md5(order_id || '|' || item_id || '|FULFILLED|' || strftime(up_t, '%Y-%m-%d %H:%M:%S.%g'))
           AS "eventId",
         order_id AS "orderId", 'LINE_ITEM_STATUS_CHANGED' AS "eventType",
         up_t AS "eventTimestamp", NULL::VARCHAR AS "orderSource", NULL::VARCHAR AS location,
         NULL::VARCHAR AS "loyaltyMemberId", 'FULFILLED' AS "orderStatus", item_id AS "itemId",
         p_brand AS item, c_name AS name, NULL::DECIMAL(10,2) AS price,
         'FULFILLED' AS "lineItemStatus",
         CASE WHEN starts_with(made_by, 'qdca10pro') THEN 'QDCA10PRO'
              WHEN starts_with(made_by, 'qdca10') THEN 'QDCA10' END AS "assemblyLine",
         made_by AS "madeBy",
         CASE WHEN starts_with(made_by, 'qdca10pro') THEN 'qdca10pro'
              WHEN starts_with(made_by, 'qdca10') THEN 'qdca10' END AS "sourceDomain",
         'orders-up' AS "sourceTopic"
  FROM up)"""


def _cancelled(name: str, when: str) -> str:
    return f"""
{name} AS (
  SELECT md5(order_id || '|' || item_id || '|ORDER_CANCELLED|'
             || strftime(ct, '%Y-%m-%d %H:%M:%S.%g')) AS "eventId",
         order_id AS "orderId", 'ORDER_CANCELLED' AS "eventType", ct AS "eventTimestamp",
         NULL::VARCHAR AS "orderSource", NULL::VARCHAR AS location,
         NULL::VARCHAR AS "loyaltyMemberId", 'CANCELLED' AS "orderStatus", item_id AS "itemId",
         p_brand AS item, NULL::VARCHAR AS name, NULL::DECIMAL(10,2) AS price,
         NULL::VARCHAR AS "lineItemStatus", NULL::VARCHAR AS "assemblyLine",
         NULL::VARCHAR AS "madeBy", 'qdca10' AS "sourceDomain", 'eighty-six' AS "sourceTopic"
  FROM (SELECT *, {when} AS ct FROM li WHERE l_returnflag = 'R' AND l_linestatus = 'O'))"""


_HUB = ",".join(
    [
        _LINES,
        _PLACED,
        _STATUS,
        _cancelled("cancelled", "t + to_seconds(120)"),
        """
hub AS (SELECT * FROM placed UNION ALL SELECT * FROM status UNION ALL SELECT * FROM cancelled)""",
    ]
)
# replayed cancellations take their time from the line alone
_REPLAYED = (
    _LINES.replace("JOIN orders", "LEFT JOIN orders")
    + ","
    + _cancelled("cancelled", "TIMESTAMP '2024-01-01' + to_seconds(l_orderkey * 104729 % 2592000)")
)
_STOCK = """
inv AS (
  SELECT 'sku-' || user_id AS sku_id, 'Brand#' || (user_id % 25 + 1) AS item,
         CASE event_type WHEN 'purchase' THEN 'RESTOCK_REQUESTED_EVENT'
           WHEN 'view' THEN 'RESTOCK_COMPLETED_EVENT' ELSE 'OTHER_EVENT' END AS raw_type,
         CAST(floor(value) AS BIGINT) AS quantity, date_trunc('millisecond', ts) AS ts
  FROM events WHERE event_type <> 'click'),
dec AS (
  SELECT 'Brand#' || (user_id % 25 + 1) AS item, CAST(floor(value) AS BIGINT) AS quantity,
         date_trunc('millisecond', ts) AS ts
  FROM events WHERE event_type = 'click'),
stock_events AS (
  SELECT md5(coalesce(sku_id, '') || '|' || coalesce(item, '') || '|' || raw_type || '|'
             || coalesce(quantity::VARCHAR, '') || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g'))
           AS event_id,
         sku_id, item,
         CASE raw_type WHEN 'RESTOCK_REQUESTED_EVENT' THEN 'RESTOCK_REQUESTED'
           WHEN 'RESTOCK_COMPLETED_EVENT' THEN 'RESTOCK_COMPLETED' ELSE raw_type END AS event_type,
         ts AS event_timestamp, 'inventory-out' AS source_topic
  FROM inv)"""
_LENIENT = """SELECT sku_id AS "skuId", item, raw_type AS "eventType",
       CASE WHEN quantity % 7 <> 3 THEN quantity END AS quantity, ts AS event_time
  FROM inv WHERE quantity % 5 <> 0"""
_PARTIALS = (
    _REPLAYED
    + ","
    + _STOCK
    + """,
partials AS (
  SELECT item, time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start,
         time_bucket(INTERVAL 1 HOUR, event_timestamp) + INTERVAL 1 HOUR AS window_end,
         count(*) AS restock_requested_count, 0::BIGINT AS stockout_cancelled_count
  FROM stock_events WHERE event_type = 'RESTOCK_REQUESTED' GROUP BY ALL
  UNION ALL
  SELECT item, time_bucket(INTERVAL 1 HOUR, "eventTimestamp"),
         time_bucket(INTERVAL 1 HOUR, "eventTimestamp") + INTERVAL 1 HOUR,
         0::BIGINT, count(*)
  FROM cancelled GROUP BY ALL),
turnover AS (
  SELECT item, window_start, window_end,
         sum(restock_requested_count)::BIGINT AS restock_requested_count,
         sum(stockout_cancelled_count)::BIGINT AS stockout_cancelled_count
  FROM partials GROUP BY ALL)"""
)
_CURRENT = """
current_orders AS (
  SELECT "orderId" AS order_id,
         max({'ts': "eventTimestamp", 'stage': CASE "orderStatus" WHEN 'PLACED' THEN 0
           WHEN 'IN_PROGRESS' THEN 1 WHEN 'FULFILLED' THEN 2 ELSE 3 END,
           'v': "orderStatus"}).v AS order_status,
         (max({'ts': "eventTimestamp", 'v': "orderSource"})
           FILTER (WHERE "orderSource" IS NOT NULL)).v AS order_source,
         (max({'ts': "eventTimestamp", 'v': location})
           FILTER (WHERE location IS NOT NULL)).v AS location,
         (max({'ts': "eventTimestamp", 'v': "loyaltyMemberId"})
           FILTER (WHERE "loyaltyMemberId" IS NOT NULL)).v AS loyalty_member_id,
         min("eventTimestamp") FILTER (WHERE "eventType" = 'ORDER_PLACED') AS placed_at,
         max("eventTimestamp") AS last_updated_at,
         (max({'ts': "eventTimestamp", 'v': "assemblyLine"})
           FILTER (WHERE "assemblyLine" IS NOT NULL)).v AS assembly_line
  FROM hub GROUP BY "orderId")"""
_CUSTOMER = """
history AS (
  SELECT name AS customer_name, "loyaltyMemberId" AS loyalty_member_id, location,
         "orderId" AS order_id, "eventTimestamp" AS event_timestamp
  FROM placed WHERE name IS NOT NULL AND name <> ''),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_name
                               ORDER BY event_timestamp DESC, order_id DESC) AS rn,
         count(*) OVER (PARTITION BY customer_name) AS total_orders
  FROM history),
full_profile AS (
  SELECT customer_name, loyalty_member_id, location AS last_location,
         order_id AS last_order_id, event_timestamp AS last_order_at, total_orders
  FROM ranked WHERE rn = 1),
masked_profile AS (
  SELECT substr(customer_name, 1, 1) || '***' AS customer_name,
         CASE WHEN loyalty_member_id IS NOT NULL THEN '***' END AS loyalty_member_id,
         last_location, last_order_id, last_order_at, total_orders
  FROM full_profile),
profile_360 AS (
  SELECT customer_name AS "customerName",
         (max({'ts': event_timestamp, 'v': loyalty_member_id})
           FILTER (WHERE loyalty_member_id IS NOT NULL)).v AS "loyaltyMemberId",
         (max({'ts': event_timestamp, 'v': location})
           FILTER (WHERE location IS NOT NULL)).v AS "lastLocation",
         max({'ts': event_timestamp, 'v': order_id}).v AS "lastOrderId",
         max(event_timestamp) AS "lastOrderAt", count(DISTINCT order_id) AS "totalOrders"
  FROM history GROUP BY customer_name)"""
_ITEM_STATUS = """
changes AS (
  SELECT order_id, item_id, p_brand AS item, 'LINE_ITEM_STATUS_CHANGED' AS kind,
         'PLACED' AS status, t AS ts,
         CASE WHEN l_suppkey % 2 = 0 THEN 'QDCA10' ELSE 'QDCA10PRO' END AS line FROM li
  UNION ALL
  SELECT order_id, item_id, p_brand, 'LINE_ITEM_STATUS_CHANGED', 'IN_PROGRESS',
         t + to_seconds(30),
         CASE WHEN l_suppkey % 2 = 0 THEN 'QDCA10' ELSE 'QDCA10PRO' END
  FROM li WHERE l_returnflag = 'A'
  UNION ALL
  SELECT order_id, item_id, p_brand, 'ORDER_CANCELLED', 'CANCELLED', t + to_seconds(40), NULL
  FROM li WHERE l_returnflag = 'R' AND l_linenumber = 1
  UNION ALL
  SELECT order_id, item_id, p_brand, 'LINE_ITEM_STATUS_CHANGED', 'FULFILLED',
         t + to_seconds(60 * CAST(l_quantity AS INT)),
         CASE WHEN starts_with(made_by, 'qdca10pro') THEN 'QDCA10PRO'
              WHEN starts_with(made_by, 'qdca10') THEN 'QDCA10' END
  FROM li WHERE l_linestatus = 'F')"""
_HUB_CHANGES = """
changes AS (
  SELECT "orderId" AS order_id, "itemId" AS item_id, item, "eventType" AS kind,
         "orderStatus" AS status, "eventTimestamp" AS ts, "assemblyLine" AS line FROM hub)"""


def _lead_times(start_kinds: str) -> str:
    return f"""
classed AS (
  SELECT *, CASE WHEN kind IN ({start_kinds}) AND status = 'PLACED' THEN line || ':P'
                 WHEN kind = 'LINE_ITEM_STATUS_CHANGED' AND status = 'IN_PROGRESS'
                   THEN line || ':I'
                 WHEN kind = 'LINE_ITEM_STATUS_CHANGED' AND status = 'FULFILLED'
                   THEN line || ':F' END AS class,
         CASE WHEN kind IN ({start_kinds}) AND status = 'PLACED' AND line IS NOT NULL THEN 0
              WHEN line IS NOT NULL AND status = 'IN_PROGRESS' THEN 1
              WHEN line IS NOT NULL AND status = 'FULFILLED' THEN 2 ELSE 3 END AS place
  FROM changes),
ahead AS (
  SELECT *, lead(class, 1) OVER w AS c1, lead(ts, 1) OVER w AS t1,
         lead(class, 2) OVER w AS c2, lead(ts, 2) OVER w AS t2
  FROM classed WINDOW w AS (PARTITION BY item_id ORDER BY ts, place, order_id, item)),
lead_time AS (
  SELECT item_id, order_id, item, ts AS placed_at,
         CASE WHEN c1 = line || ':F' THEN t1 ELSE t2 END AS fulfilled_at,
         date_sub('second', ts, CASE WHEN c1 = line || ':F' THEN t1 ELSE t2 END)
           AS lead_time_seconds,
         line AS assembly_line
  FROM ahead
  WHERE class = line || ':P'
    AND (c1 = line || ':F' OR (c1 = line || ':I' AND c2 = line || ':F')))"""


_LEAD = ",".join([_LINES, _ITEM_STATUS, _lead_times("'LINE_ITEM_STATUS_CHANGED'")])
_LEAD_HUB = ",".join([_HUB, _HUB_CHANGES, _lead_times("'LINE_ITEM_STATUS_CHANGED'")])
_LEAD_ENRICHED = ",".join(
    [_HUB, _HUB_CHANGES, _lead_times("'LINE_ITEM_STATUS_CHANGED', 'ORDER_PLACED'")]
)


def _trends(width: str) -> str:
    return f"""
trend AS (
  SELECT item, time_bucket(INTERVAL {width}, "eventTimestamp") AS window_start,
         time_bucket(INTERVAL {width}, "eventTimestamp") + INTERVAL {width} AS window_end,
         count(*) AS order_count, CAST(sum(price) AS DECIMAL(12,2)) AS revenue,
         "assemblyLine" AS assembly_line, location
  FROM status GROUP BY ALL)"""


def _trends_enriched(width: str) -> str:
    return f"""
enriched AS (
  SELECT s.item, time_bucket(INTERVAL {width}, s."eventTimestamp") AS window_start,
         time_bucket(INTERVAL {width}, s."eventTimestamp") + INTERVAL {width} AS window_end,
         count(*) AS order_count, CAST(sum(p.price) AS DECIMAL(12,2)) AS revenue,
         s."assemblyLine" AS assembly_line, p.location
  FROM status s LEFT JOIN placed p ON p."orderId" = s."orderId" AND p."itemId" = s."itemId"
  GROUP BY ALL)"""


# one placement per line key, the newest: a fulfilment counts once however often it was placed
_NEWEST_PLACED = """
newest AS (
  SELECT "orderId", "itemId",
         max({'ts': "eventTimestamp", 'price': price, 'location': location}) AS p
  FROM placed GROUP BY "orderId", "itemId")"""


def _trends_enriched_once(width: str) -> str:
    return (
        _NEWEST_PLACED
        + ","
        + _trends_enriched(width)
        .replace("p.price", "p.p.price")
        .replace("p.location", "p.p.location")
        .replace("JOIN placed p", "JOIN newest p")
    )


_COMPLETION = """
messages AS (
  SELECT order_id, item_id AS line_item_id, p_brand AS item, c_name AS name,
         CASE WHEN l_suppkey % 17 = 0 THEN 'unknown'
              ELSE strftime(up_t, '%Y-%m-%dT%H:%M:%S.%gZ') END AS time_text,
         made_by
  FROM up),
completions AS (
  SELECT order_id, line_item_id, item, name,
         try_strptime(time_text, '%Y-%m-%dT%H:%M:%S.%gZ') AS completed_at, made_by,
         order_id IS NOT NULL AND line_item_id IS NOT NULL AND item IS NOT NULL
           AND name IS NOT NULL
           AND try_strptime(time_text, '%Y-%m-%dT%H:%M:%S.%gZ') IS NOT NULL AS conforms
  FROM messages)"""
_ASSEMBLY = """
marked AS (
  SELECT "orderId" AS order_id, "eventTimestamp" AS ts, price,
         CASE WHEN ts - lag(ts) OVER w > INTERVAL 5 SECOND THEN 1 ELSE 0 END AS starts
  FROM placed WINDOW w AS (PARTITION BY "orderId" ORDER BY "eventTimestamp")),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY order_id ORDER BY ts
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session
  FROM marked),
assembled AS (
  SELECT order_id, min(ts) AS first_line_at, max(ts) AS last_line_at, count(*) AS line_count,
         CAST(sum(price) AS DECIMAL(12,2)) AS total_price
  FROM numbered GROUP BY order_id, session)"""
_HISTORY_COLUMNS = """
  "eventId" AS event_id, "orderId" AS order_id, "eventType" AS event_type,
  "eventTimestamp" AS event_timestamp, "orderSource" AS order_source, location,
  "loyaltyMemberId" AS loyalty_member_id, "orderStatus" AS order_status,
  "itemId" AS line_item_id, name AS line_item_name, price AS line_item_price,
  "lineItemStatus" AS line_item_status, "assemblyLine" AS assembly_line,
  "sourceDomain" AS source_domain, "sourceTopic" AS source_topic"""


def _contract_parts() -> dict[str, list[str]]:
    """One count per product, field and rule."""

    def count(product: str, table: str, field: str, rule: str, broken: str) -> str:
        return (
            f"SELECT '{product}' AS product, '{field}' AS field, '{rule}' AS rule, "
            f"count(*) FILTER (WHERE {broken}) AS violations FROM {table}"
        )

    def required(product: str, table: str, **columns: str) -> list[str]:
        return [
            count(product, table, f.replace("__", "."), "required", f"{c} IS NULL")
            for f, c in columns.items()
        ]

    def allowed(product: str, table: str, field: str, column: str, values: str) -> str:
        return count(product, table, field, "allowed values", f"{column} NOT IN ({values})")

    parts: dict[str, list[str]] = {}
    parts["order_event"] = required(
        "order_event",
        "hub",
        eventId='"eventId"',
        orderId='"orderId"',
        eventType='"eventType"',
        eventTimestamp='"eventTimestamp"',
        lineItem__itemId='"itemId"',
        lineItem__item="item",
        lineItem__name="name",
        lineItem__price="price",
        lineItem__lineItemStatus='"lineItemStatus"',
        sourceDomain='"sourceDomain"',
        sourceTopic='"sourceTopic"',
    )
    for field, column, values in [
        ("eventType", '"eventType"', "'ORDER_PLACED','LINE_ITEM_STATUS_CHANGED','ORDER_CANCELLED'"),
        ("orderSource", '"orderSource"', "'COUNTER','WEB','PARTNER'"),
        ("location", "location", "'ATLANTA','CHARLOTTE','RALEIGH','TOKYO'"),
        ("orderStatus", '"orderStatus"', "'PLACED','IN_PROGRESS','FULFILLED','CANCELLED'"),
        ("lineItem.lineItemStatus", '"lineItemStatus"', "'PLACED','IN_PROGRESS','FULFILLED'"),
        ("lineItem.assemblyLine", '"assemblyLine"', "'QDCA10','QDCA10PRO'"),
    ]:
        parts["order_event"].append(allowed("order_event", "hub", field, column, values))
    parts["stock_event"] = required(
        "stock_event",
        "stock_events",
        **{
            c: c
            for c in (
                "event_id",
                "sku_id",
                "item",
                "event_type",
                "event_timestamp",
                "source_topic",
            )
        },
    )
    parts["stock_event"].append(
        allowed(
            "stock_event",
            "stock_events",
            "event_type",
            "event_type",
            "'RESTOCK_REQUESTED','RESTOCK_COMPLETED'",
        )
    )
    parts["sales_trend"] = required(
        "sales_trend",
        "trend",
        **{c: c for c in ("item", "window_start", "window_end", "order_count", "revenue")},
    )
    parts["customer_profile"] = required(
        "customer_profile",
        "profile_360",
        customerName='"customerName"',
        totalOrders='"totalOrders"',
    )
    for product, frame, columns in [
        ("stock_quantity", "quantities", "item quantity last_restocked_at"),
        (
            "turnover",
            "turnover",
            "item window_start window_end restock_requested_count stockout_cancelled_count",
        ),
        ("stockout_risk", "risk", "item at_risk last_stockout_event_at"),
        (
            "lead_time",
            "lead_time",
            "item_id order_id placed_at fulfilled_at lead_time_seconds assembly_line",
        ),
    ]:
        parts[product] = required(product, frame, **{c: c for c in columns.split()})
    parts["completion"] = required(
        "completion",
        "messages",
        orderId="order_id",
        lineItemId="line_item_id",
        item="item",
        name="name",
        timestamp="time_text",
    )
    return parts


def _broken(*products: str) -> str:
    parts = [x for p in products for x in _contract_parts()[p]]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE violations > 0"


def _contract_sql() -> dict[str, str]:
    cancelled = _LINES + "," + _cancelled("cancelled", "t + to_seconds(120)")
    ctes = {
        "order_event": _HUB,
        "stock_event": _STOCK,
        "stock_quantity": f"{_STOCK}, quantities AS ({_QUANTITY})",
        "sales_trend": _UP + "," + _trends("1 DAY"),
        "turnover": _PARTIALS,
        "stockout_risk": f"""{cancelled}, risk AS (
          SELECT item, TRUE AS at_risk, max("eventTimestamp") AS last_stockout_event_at
          FROM cancelled GROUP BY item, time_bucket(INTERVAL 1 HOUR, "eventTimestamp"))""",
        "lead_time": _LEAD,
        "customer_profile": _PROFILE,
        "completion": _UP + "," + _COMPLETION,
    }
    return {f"contract_{p}": _with(c, _broken(p)) for p, c in ctes.items()}


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


_UP = _LINES + "," + _STATUS
_IN = _LINES + "," + _PLACED
_PROFILE = _IN + "," + _CUSTOMER
_QUANTITY = """
  SELECT item, max({'ts': ts, 'r': r, 'q': quantity}).q AS quantity, max(ts) AS last_restocked_at
  FROM (SELECT item, ts, 0 AS r, quantity FROM inv WHERE raw_type = 'RESTOCK_COMPLETED_EVENT'
        UNION ALL SELECT item, ts, 1, quantity FROM dec) GROUP BY item"""
_STOCK_CURRENT = """
  SELECT sku_id, max({'ts': event_timestamp, 's': event_type, 'i': item}).i AS item,
         max({'ts': event_timestamp, 's': event_type, 'i': item}).s AS latest_status,
         max(event_timestamp) AS last_event_at
  FROM stock_events GROUP BY sku_id"""
_RISK_CURRENT = """
  SELECT item, TRUE AS at_risk, max("eventTimestamp") AS last_stockout_event_at
  FROM cancelled GROUP BY item"""


def batch_sql() -> dict[str, str]:
    cancelled = _LINES + "," + _cancelled("cancelled", "t + to_seconds(120)")
    return {
        "order_placed_events": _with(_IN, "SELECT * FROM placed"),
        "line_status_events": _with(_UP, "SELECT * FROM status"),
        "cancelled_events": _with(cancelled, "SELECT * FROM cancelled"),
        "order_events": _with(_HUB, "SELECT * FROM hub"),
        "order_events_history": _with(_HUB, f"SELECT {_HISTORY_COLUMNS} FROM hub"),
        "order_events_current": _with(_HUB + "," + _CURRENT, "SELECT * FROM current_orders"),
        "trends_5m": _with(_UP + "," + _trends("5 MINUTE"), "SELECT * FROM trend"),
        "trends_daily": _with(_UP + "," + _trends("1 DAY"), "SELECT * FROM trend"),
        "trends_enriched": _with(
            ",".join([_LINES, _PLACED, _STATUS, _trends_enriched_once("1 DAY")]),
            "SELECT * FROM enriched",
        ),
        "inventory_events": _with(_STOCK, "SELECT * FROM stock_events"),
        "stock_current": _with(_STOCK, _STOCK_CURRENT),
        "stock_quantity": _with(_STOCK, _QUANTITY),
        "turnover_partials": _with(_PARTIALS, "SELECT * FROM partials"),
        "turnover": _with(_PARTIALS, "SELECT * FROM turnover"),
        "turnover_from_partials": _with(_PARTIALS, "SELECT * FROM turnover"),
        "stockout_risk_current": _with(cancelled, _RISK_CURRENT),
        "stockout_risk_hourly": _with(
            cancelled,
            """SELECT item, TRUE AS at_risk, max("eventTimestamp") AS last_stockout_event_at
               FROM cancelled GROUP BY item, time_bucket(INTERVAL 1 HOUR, "eventTimestamp")""",
        ),
        "lead_time_line_a": _with(_LEAD, "SELECT * FROM lead_time WHERE assembly_line = 'QDCA10'"),
        "lead_time_line_b": _with(
            _LEAD, "SELECT * FROM lead_time WHERE assembly_line = 'QDCA10PRO'"
        ),
        "lead_time_all_lines": _with(_LEAD, "SELECT * FROM lead_time"),
        "lead_time_on_hub": _with(_LEAD_HUB, "SELECT * FROM lead_time"),
        "lead_time_enriched": _with(_LEAD_ENRICHED, "SELECT * FROM lead_time"),
        "customer_360_current": _with(_PROFILE, "SELECT * FROM profile_360"),
        "customer_history": _with(_PROFILE, "SELECT * FROM history"),
        "profile_full": _with(_PROFILE, "SELECT * FROM full_profile"),
        "profile_masked": _with(_PROFILE, "SELECT * FROM masked_profile"),
        "profile_for_group": _with(
            _PROFILE,
            """SELECT 'customer360-full' AS caller_group, * FROM full_profile
               UNION ALL SELECT 'consumer', * FROM masked_profile""",
        ),
        "completion_contract": _with(_UP + "," + _COMPLETION, "SELECT * FROM completions"),
        "contract_violations": _with(
            ",".join([_HUB, _STOCK, _trends("1 DAY"), _CUSTOMER]),
            _broken("order_event", "stock_event", "sales_trend", "customer_profile"),
        ),
        "order_assembly": _with(_IN + "," + _ASSEMBLY, "SELECT * FROM assembled"),
        "json_strict_completions": _with(
            _UP,
            """SELECT order_id AS "orderId", item_id AS "lineItemId", p_brand AS item,
                      c_name AS name, made_by AS "madeBy", up_t AS event_time FROM up""",
        ),
        "json_lenient_stock": _with(_STOCK, _LENIENT),
        "inventory_events_lake": _with(_STOCK, "SELECT * FROM stock_events"),
        "view_orders_current": _with(_HUB + "," + _CURRENT, "SELECT * FROM current_orders"),
        "view_turnover": _with(_PARTIALS, "SELECT * FROM turnover"),
        "view_all_lines": _with(_LEAD, "SELECT * FROM lead_time"),
        "view_profile_full": _with(_PROFILE, "SELECT * FROM full_profile"),
        "view_profile_masked": _with(_PROFILE, "SELECT * FROM masked_profile"),
        **_contract_sql(),
        "inventory_events_days": _with(
            _STOCK,
            """SELECT * FROM stock_events
               WHERE event_timestamp >= DATE '2024-01-05' AND event_timestamp < DATE '2024-01-15'""",
        ),
    }


# Completions dealt to eight batches by arrival. A batch drops groups whose window ended before
# the watermark that held when the batch before it began: the newest time of all files up to
# the one two before, less the delay.
_LATE = """
arrived AS (
  SELECT *, "eventTimestamp" + to_days(CASE WHEN CAST("orderId" AS BIGINT) % 7 = 3 THEN 700 ELSE 0 END)
           AS arrival,
         time_bucket(INTERVAL 1 DAY, "eventTimestamp") + INTERVAL 1 DAY AS ends
  FROM status),
dealt AS (
  SELECT *, CAST(greatest(0, least(7, floor(
           (epoch_us(arrival) - epoch_us(TIMESTAMP '1995-01-01')) * 8
           / (epoch_us(TIMESTAMP '2002-01-01') - epoch_us(TIMESTAMP '1995-01-01'))))) AS BIGINT) AS batch
  FROM arrived),
marks AS (
  SELECT b.batch, (SELECT max("eventTimestamp") FROM dealt d WHERE d.batch <= b.batch - 2)
           - INTERVAL 10 SECOND AS mark
  FROM (SELECT DISTINCT batch FROM dealt) b),
judged AS (SELECT dealt.*, coalesce(ends <= mark, FALSE) AS late FROM dealt JOIN marks USING (batch)),
kept AS (SELECT * FROM judged WHERE NOT late)"""


def stream_sql() -> dict[str, str]:
    """A stream that has read everything has emitted what lies behind its watermark: the
    newest event time of the slowest input, less the delay."""
    cancelled = _LINES + "," + _cancelled("cancelled", "t + to_seconds(120)")

    def newest(table: str, column: str = '"eventTimestamp"') -> str:
        return f"(SELECT max({column}) FROM {table})"

    hub_mark = newest("hub") + " - INTERVAL 10 SECOND"
    slowest = f"least({newest('stock_events', 'event_timestamp')}, {newest('cancelled')})"
    join_mark = f"least({newest('status')}, {newest('placed')}) - INTERVAL 10 SECOND"
    return {
        "order_events_stream": _with(_HUB, f"SELECT {_HISTORY_COLUMNS} FROM hub"),
        "inventory_events_stream": _with(_STOCK, "SELECT * FROM stock_events"),
        "customer_history_stream": _with(_PROFILE, "SELECT * FROM history"),
        "turnover_partials_stream": _with(
            _PARTIALS,
            f"SELECT * FROM partials WHERE window_end <= {slowest} - INTERVAL 10 SECOND",
        ),
        "trends_5m_stream": _with(
            _HUB + "," + _trends("5 MINUTE"), f"SELECT * FROM trend WHERE window_end <= {hub_mark}"
        ),
        "trends_daily_stream": _with(
            _HUB + "," + _trends("1 DAY"), f"SELECT * FROM trend WHERE window_end <= {hub_mark}"
        ),
        "trends_daily_stored_hub_stream": _with(
            _HUB + "," + _trends("1 DAY"), f"SELECT * FROM trend WHERE window_end <= {hub_mark}"
        ),
        "trends_late_stream": _with(
            ",".join([_LINES, _STATUS, _LATE, _trends("1 DAY").replace("FROM status", "FROM kept")]),
            f"SELECT * FROM trend WHERE window_end <= {newest('status')} - INTERVAL 10 SECOND",
        ),
        "trends_late_batches_stream": _with(
            ",".join([_LINES, _STATUS, _LATE]),
            """SELECT batch, CAST(count(*) AS BIGINT) AS rows_read,
                      CAST(count(DISTINCT CASE WHEN late THEN (ends, item, "assemblyLine", location)
                        END) AS BIGINT) AS groups_dropped
               FROM judged GROUP BY batch""",
        ),
        "trends_enriched_stream": _with(
            ",".join([_LINES, _PLACED, _STATUS, _trends_enriched_once("1 DAY")]),
            f"SELECT * FROM enriched WHERE window_end <= {join_mark}",
        ),
        "turnover_stream": _with(
            _PARTIALS,
            f"SELECT * FROM turnover WHERE window_end <= {slowest} - INTERVAL 10 SECOND",
        ),
        "stockout_risk_hourly_stream": _with(
            cancelled,
            f"""SELECT item, TRUE AS at_risk, max("eventTimestamp") AS last_stockout_event_at
                FROM cancelled
                GROUP BY item, time_bucket(INTERVAL 1 HOUR, "eventTimestamp")
                HAVING time_bucket(INTERVAL 1 HOUR, "eventTimestamp") + INTERVAL 1 HOUR
                       <= {newest("cancelled")} - INTERVAL 10 SECOND""",
        ),
        "stockout_risk_current_stream": _with(cancelled, _RISK_CURRENT),
        "stock_current_stream": _with(_STOCK, _STOCK_CURRENT),
        "stock_quantity_stream": _with(_STOCK, _QUANTITY),
        "customer_360_current_stream": _with(_PROFILE, "SELECT * FROM profile_360"),
        "customer_profile_stream": _with(_PROFILE, "SELECT * FROM profile_360"),
        "order_events_set_stream": _with(
            f"{_HUB}, history AS (SELECT {_HISTORY_COLUMNS} FROM hub)",
            """SELECT 'history' AS target, event_id, order_id, event_type FROM history
               UNION ALL SELECT lower(event_type), event_id, order_id, event_type FROM history""",
        ),
        "json_lenient_stock_stream": _with(_STOCK, _LENIENT),
        "json_quarantine_stream": _with(
            _STOCK,
            """SELECT CASE WHEN quantity % 5 = 0 THEN item ELSE
                   '{"skuId":"' || sku_id || '","item":"' || item || '","eventType":"' || raw_type
                   || '","quantity":"many"}' END AS value,
                 ts AS event_time,
                 CASE WHEN quantity % 5 = 0 THEN 'not_an_object' ELSE 'wrong_type:quantity' END AS reason
               FROM inv WHERE quantity % 5 = 0 OR quantity % 7 = 3""",
        ),
        "lead_time_stream": _with(
            _LEAD,
            f"""SELECT * FROM lead_time
                WHERE fulfilled_at <= {newest("changes", "ts")} - INTERVAL 30 SECOND""",
        ),
        "order_assembly_stream": _with(
            _IN + "," + _ASSEMBLY,
            f"""SELECT * FROM assembled
                WHERE last_line_at + INTERVAL 5 SECOND
                      <= {newest("placed")} - INTERVAL 5 SECOND""",
        ),
    }
