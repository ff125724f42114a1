"""Reference SQL for the driver queries, written against the driver's tables."""

from __future__ import annotations

FEEDS = {
    "o": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS order_status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, 'KRW' AS currency,
               CASE WHEN o_orderkey % 7 = 0 THEN 'FLASH15' END AS coupon_id,
               epoch_ms(o_orderdate) AS created_at_ms,
               CASE WHEN o_orderkey % 6 <> 0
                    THEN epoch_ms(o_orderdate) + (o_orderkey % 7) * 1000 END AS updated_at_ms,
               CASE o_orderkey % 10 WHEN 0 THEN 'r' WHEN 1 THEN 'u' WHEN 2 THEN 'd'
                    ELSE 'c' END AS __op,
               CASE WHEN o_orderkey % 3 <> 0
                    THEN epoch_ms(o_orderdate) + (o_orderkey % 50) * 1000 END AS __source_ts_ms
        FROM orders""",
    "p": """
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'P' THEN 'PENDING'
                    ELSE 'FAILED' END AS payment_status,
               CASE WHEN o_orderkey % 2 = 0 THEN 'CARD' ELSE 'TRANSFER' END AS payment_method,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               epoch_ms(o_orderdate) AS paid_at_ms,
               CASE WHEN o_orderkey % 6 <> 0
                    THEN epoch_ms(o_orderdate) + (o_orderkey % 7) * 1000 END AS updated_at_ms,
               CASE WHEN o_orderkey % 4 = 0 THEN 'u' ELSE 'c' END AS __op,
               CASE WHEN o_orderkey % 3 <> 0
                    THEN epoch_ms(o_orderdate) + (o_orderkey % 50) * 1000 END AS __source_ts_ms
        FROM orders""",
    "r": """
        SELECT l_orderkey * 10 + l_linenumber AS refund_id, l_orderkey AS order_id,
               CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey END AS payment_id,
               l_suppkey AS user_id,
               CASE WHEN l_linestatus = 'F' THEN 'SUCCEEDED' ELSE 'REQUESTED' END
                   AS refund_status,
               CASE WHEN l_linenumber > 3 THEN 'CUSTOMER_CHANGED_MIND' END AS refund_reason,
               CASE WHEN l_orderkey % 9 <> 0
                    THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS refund_amount,
               epoch_ms(l_shipdate) AS refunded_at_ms,
               CASE WHEN l_orderkey % 6 <> 0
                    THEN epoch_ms(l_shipdate) + (l_orderkey % 7) * 1000 END AS updated_at_ms,
               CASE WHEN l_orderkey % 4 = 0 THEN 'u' ELSE 'c' END AS __op,
               CASE WHEN l_orderkey % 3 <> 0
                    THEN epoch_ms(l_shipdate) + (l_orderkey % 50) * 1000 END AS __source_ts_ms
        FROM lineitem WHERE l_returnflag = 'R'""",
    "t": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tick_id,
               l_returnflag AS symbol, l_linestatus AS exchange,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CASE WHEN day(l_shipdate) = 13 THEN CAST(0 AS DECIMAL(12,2))
                    ELSE CAST(l_quantity AS DECIMAL(12,2)) END AS volume,
               CASE l_linenumber % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'CROSS' END
                   AS side,
               CAST(l_partkey AS VARCHAR) AS trade_id, 'shipments' AS ingest_source,
               epoch_ms(l_shipdate) + (l_linenumber % 2) * 1000 + l_orderkey % 1000
                   AS event_time
        FROM lineitem""",
    "b": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
               concat_ws('-', user_id, event_id % 16) AS session_id, event_type,
               CASE event_type WHEN 'view' THEN 'search' WHEN 'click' THEN 'product'
                    WHEN 'purchase' THEN 'checkout' ELSE 'home' END AS page,
               CASE WHEN event_type <> 'view' THEN item END AS product_id,
               CASE WHEN event_type = 'view' THEN 'k' || item END AS keyword,
               CASE WHEN event_type = 'click' THEN 'cart' || user_id END AS cart_id,
               CASE WHEN event_type = 'purchase' THEN event_id END AS order_id,
               CASE WHEN event_type = 'click' THEN CAST(item % 5 AS INTEGER) END AS quantity,
               CASE WHEN event_type <> 'view' THEN value END AS price,
               CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
                   AS device_type,
               'app' AS source,
               date_trunc('millisecond', ts) AS event_time
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item FROM events)""",
}


def _at(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)"


EVENT_TIMES = {
    "o": _at("coalesce(__source_ts_ms, updated_at_ms, created_at_ms)"),
    "p": _at("coalesce(__source_ts_ms, updated_at_ms, paid_at_ms)"),
    "r": _at("coalesce(__source_ts_ms, updated_at_ms, refunded_at_ms)"),
}
STAMPS = {"o": "created_at", "p": "paid_at", "r": "refunded_at"}
BUSINESS = {
    "o": "order_id, user_id, order_status, total_amount, currency, coupon_id",
    "p": "payment_id, order_id, user_id, payment_status, payment_method, amount",
    "r": "refund_id, order_id, payment_id, user_id, refund_status, refund_reason, refund_amount",
}


def _cte(name: str) -> str:
    """Common table of one feed with its computed columns."""
    if name == "t":
        return (f"t AS (SELECT *, {_at('event_time')} AS event_ts, "
                f"CAST(price * volume AS DECIMAL(25,4)) AS trade_notional FROM ({FEEDS['t']}))")
    if name == "b":
        return f"b AS ({FEEDS['b']})"
    stamp = STAMPS[name]
    return (f"{name} AS (SELECT *, {_at('updated_at_ms')} AS updated_at, "
            f"{EVENT_TIMES[name]} AS event_time FROM (SELECT *, {_at(stamp + '_ms')} AS created "
            f"FROM ({FEEDS[name]})))")


def _with(names: str, body: str, *extra: str) -> str:
    """``body`` after the common tables of the feeds in ``names`` and any others."""
    tables = [_cte(n) for n in names] + list(extra)
    return f"WITH {', '.join(tables)} {body}"


def _window(time: str, size: str) -> str:
    return f"time_bucket(INTERVAL 1 {size}, {time})"


ORDER_WINDOWS = f"""
    oc AS (SELECT {_window('event_time', 'minute')} AS window_start, count(*) AS n,
                  coalesce(sum(total_amount), 0) AS v
           FROM o WHERE __op = 'c' GROUP BY 1)"""
COMMERCE = f"""
    kpis AS (
        SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, metric_name,
               metric_value
        FROM (
            SELECT window_start, 'orders_created' AS metric_name,
                   CAST(n AS DOUBLE) AS metric_value FROM oc
            UNION ALL
            SELECT window_start, 'gross_order_value', CAST(v AS DOUBLE) FROM oc
            UNION ALL
            SELECT {_window('event_time', 'minute')}, 'payments_succeeded',
                   CAST(count(*) AS DOUBLE)
            FROM p WHERE payment_status = 'SUCCEEDED' GROUP BY 1
            UNION ALL
            SELECT {_window('event_time', 'minute')}, 'refund_amount',
                   CAST(coalesce(sum(refund_amount), 0) AS DOUBLE)
            FROM r GROUP BY 1))"""
BARS = f"""
    bars AS (
        SELECT window_start, window_start + INTERVAL 1 SECOND AS window_end, symbol, exchange,
               count(*) AS tick_count, CAST(min(price) AS DOUBLE) AS min_price,
               CAST(max(price) AS DOUBLE) AS max_price,
               CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
               CAST(sum(volume) AS DOUBLE) AS traded_volume,
               CAST(sum(trade_notional) AS DOUBLE) AS traded_notional,
               CASE WHEN sum(volume) = 0 THEN 0.0
                    ELSE CAST(sum(trade_notional) AS DOUBLE) / CAST(sum(volume) AS DOUBLE)
                    END AS vwap,
               CAST(sum(CASE WHEN side = 'BUY' THEN 1 ELSE 0 END) AS BIGINT) AS buy_tick_count,
               CAST(sum(CASE WHEN side = 'SELL' THEN 1 ELSE 0 END) AS BIGINT)
                   AS sell_tick_count
        FROM (SELECT *, {_window('event_ts', 'second')} AS window_start FROM t)
        GROUP BY window_start, symbol, exchange)"""
MARKET_WIDE = f"""
    wide AS (
        SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, symbol,
               CAST(count(*) AS DOUBLE) AS n,
               CAST(coalesce(sum(volume), 0) AS DOUBLE) AS v,
               CAST(coalesce(sum(trade_notional), 0) AS DOUBLE) AS a,
               CAST(max(price) - min(price) AS DOUBLE) AS spread
        FROM (SELECT *, {_window('event_ts', 'minute')} AS window_start FROM t)
        GROUP BY window_start, symbol)"""
MARKET = """
    market AS (
        SELECT window_start, window_end, symbol, metric_name, metric_value
        FROM (
            SELECT *, 'tick_count_1m' AS metric_name, n AS metric_value FROM wide
            UNION ALL SELECT *, 'traded_volume_1m', v FROM wide
            UNION ALL SELECT *, 'traded_notional_1m', a FROM wide
            UNION ALL SELECT *, 'vwap_1m', CASE WHEN v = 0 THEN 0.0 ELSE a / v END FROM wide
            UNION ALL SELECT *, 'price_volatility_1m', spread FROM wide))"""

COMMERCE_NAMES = "'orders_created', 'gross_order_value', 'payments_succeeded', 'refund_amount'"
MARKET_NAMES = ("'tick_count_1m', 'traded_volume_1m', 'traded_notional_1m', 'vwap_1m', "
                "'price_volatility_1m'")
LISTED = "window_start, window_end, metric_name, metric_value"


def _commerce(body: str, *extra: str) -> str:
    return _with("opr", body, ORDER_WINDOWS, COMMERCE, *extra)


def _market(body: str, *extra: str) -> str:
    return _with("t", body, MARKET_WIDE, MARKET, *extra)


def _both(body: str, *extra: str) -> str:
    return _with("oprt", body, ORDER_WINDOWS, COMMERCE, MARKET_WIDE, MARKET, *extra)


def _scan(name: str) -> str:
    stamp = STAMPS[name]
    return _with(name, f"""
        SELECT {BUSINESS[name]}, {stamp}_ms, updated_at_ms, __op, __source_ts_ms,
               created AS {stamp}, updated_at, event_time FROM {name}""")


def _bronze(name: str) -> str:
    return _with(name, f"""
        SELECT {BUSINESS[name]}, created AS {STAMPS[name]}, updated_at, __op AS cdc_op,
               {_at('__source_ts_ms')} AS cdc_source_ts FROM {name}""")


ORDER_EVENTS = """
    SELECT CAST(order_id AS VARCHAR) AS event_id, user_id, 'order' AS entity_type,
           order_status AS event_status, total_amount AS amount, event_time,
           'postgres_cdc' AS source_system FROM o
    UNION ALL
    SELECT CAST(payment_id AS VARCHAR), user_id, 'payment', payment_status, amount, event_time,
           'postgres_cdc' FROM p
    UNION ALL
    SELECT CAST(refund_id AS VARCHAR), user_id, 'refund', refund_status, refund_amount,
           event_time, 'postgres_cdc' FROM r"""
BRONZE_TICKS = """
    SELECT tick_id, symbol, exchange, CAST(price AS DOUBLE) AS price,
           CAST(volume AS DOUBLE) AS volume, side, trade_id,
           CAST(trade_notional AS DOUBLE) AS trade_notional, ingest_source,
           event_ts AS event_time FROM t"""
BEHAVIOR = ("event_id, user_id, session_id, event_type, page, product_id, keyword, order_id, "
            "quantity, price, device_type, source, event_time")

# Faults the quality queries put on some days of the month.
_DAY = "day(window_start)"
DAMAGE = f"""
    CASE WHEN {_DAY} <> 24 THEN window_start END AS window_start,
    CASE WHEN {_DAY} = 27 THEN 'unlisted' ELSE metric_name END AS metric_name,
    CASE WHEN {_DAY} = 26 THEN NULL WHEN {_DAY} = 25 THEN -metric_value ELSE metric_value END
        AS metric_value"""
DIRTY_COMMERCE = f"""
    dirty_commerce AS (
        SELECT 'x' AS symbol, {DAMAGE},
               (SELECT max(event_time) FROM o) - INTERVAL 400 DAY AS since FROM kpis)"""
DIRTY_MARKET = f"""
    dirty_market AS (
        SELECT CASE WHEN {_DAY} <> 23 THEN symbol END AS symbol, {DAMAGE},
               (SELECT max(event_time) FROM o) - INTERVAL 400 DAY AS since FROM market)"""


def _suite(suite: str, table: str, names: str) -> str:
    return f"""
        SELECT '{suite}' AS suite, count(*) AS observed_rows, count(*) >= 1 AS success
        FROM {table}
        WHERE window_start >= since AND window_start IS NOT NULL AND symbol IS NOT NULL
          AND metric_name IN ({names}) AND metric_value >= 0"""


def _rejected(suite: str, table: str, names: str, symbol: bool) -> str:
    rules = {
        "recent": "window_start >= since",
        "window_start_present": "window_start IS NOT NULL",
        "symbol_present": "symbol IS NOT NULL",
        "known_metric": f"metric_name IN ({names})",
        "not_negative": "metric_value >= 0",
    }
    if not symbol:
        del rules["symbol_present"]
    return " UNION ALL ".join(
        f"SELECT '{suite}' AS suite, '{rule}' AS rule, "
        f"CAST(sum(CASE WHEN {test} THEN 0 ELSE 1 END) AS BIGINT) AS rejected_rows FROM {table}"
        for rule, test in rules.items())


CHECK_COMMERCE = _suite("gold_commerce_kpis_suite", "dirty_commerce", COMMERCE_NAMES)
CHECK_MARKET = _suite("gold_crypto_market_kpis_suite", "dirty_market", MARKET_NAMES)


def _counts(*tables: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in tables)


def _lag(name: str, source: str) -> str:
    return f"""
        SELECT '{name}' AS table_name, count(*) AS measured_rows, avg(lag_ms) AS avg_lag_ms,
               max(lag_ms) AS max_lag_ms, quantile_disc(lag_ms, 0.95) AS p95_lag_ms,
               CAST(sum(CASE WHEN lag_ms <= 5000 THEN 1 ELSE 0 END) AS BIGINT)
                   AS rows_in_target
        FROM (SELECT CAST(floor(metric_value) AS BIGINT) % 9 * 1000 AS lag_ms FROM {source})"""


def _lag_days(name: str, source: str) -> str:
    return f"""
        SELECT '{name}' AS table_name, CAST(window_end AS DATE) AS day,
               count(*) AS measured_rows, avg(lag_ms) AS avg_lag_ms, max(lag_ms) AS max_lag_ms,
               CAST(sum(CASE WHEN lag_ms <= 5000 THEN 1 ELSE 0 END) AS BIGINT)
                   AS rows_in_target, true AS p95_in_bounds
        FROM (SELECT window_end, CAST(floor(metric_value) AS BIGINT) % 9 * 1000 AS lag_ms
              FROM {source})
        GROUP BY CAST(window_end AS DATE)"""


def _hashed(*tables: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, true AS one_file_a_key "
        f"FROM {source}" for name, source in tables)


TIME_TRAVEL = f"SELECT {LISTED} FROM kpis WHERE window_start < TIMESTAMP '1999-01-01'"
NEWEST_50 = "ORDER BY window_start DESC, metric_name LIMIT 50"
LAYER_COUNTS = (
    ("bronze.orders_cdc", "o"), ("bronze.payments_cdc", "p"), ("bronze.refunds_cdc", "r"),
    ("bronze.crypto_ticks", "t"), ("silver.order_events", "order_events"),
    ("silver.crypto_ticks_1s", "bars"), ("gold.commerce_kpis_1m", "kpis"),
    ("gold.crypto_market_kpis_1m", "market"),
)
OTHER_COUNTS = (
    ("bronze.user_behavior_events", "events"), ("silver.user_behavior", "events"),
    ("gold.behavior_kpis_1m", "(SELECT 1 WHERE false)"),
)
EVENT_UNION = f"order_events AS ({ORDER_EVENTS})"


def _newest(entity: str, key: str, status: str, table: str, limit: int) -> str:
    return f"""(SELECT '{entity}' AS entity, {key} AS id, {status} AS status,
                       created AS event_ts FROM {table}
                ORDER BY id DESC, event_ts DESC, status LIMIT {limit})"""


# A stream emits the windows its watermark has passed: all but the last few seconds.
def _closed(source: str, feed: str, time: str) -> str:
    return (f"FROM {source} WHERE window_end <= "
            f"(SELECT max({time}) - INTERVAL 5 SECOND FROM {feed})")


ORDERS_MESSAGE = "order_id % 11"
BAR_VALUES = ("min_price", "max_price", "avg_price", "traded_volume", "traded_notional", "vwap")
LATE = """CAST(split_part(tick_id, '-', 1) AS BIGINT) % 10 = 0
        AND event_ts < TIMESTAMP '1997-01-01'"""
EARLY_PAYMENTS = "(SELECT * FROM p WHERE created < TIMESTAMP '1997-01-01')"
CHECKPOINT = """
        SELECT suite, observed_rows, success FROM results
        UNION ALL
        SELECT 'lakehouse_gold_checkpoint', CAST(sum(observed_rows) AS BIGINT),
               bool_and(success) FROM results"""
LAST_DAY = (
    DIRTY_COMMERCE.replace("400 DAY", "1 DAY"), DIRTY_MARKET.replace("400 DAY", "1 DAY"),
    f"results AS ({CHECK_COMMERCE} UNION ALL {CHECK_MARKET})")
SQL = {
    "scan_orders_cdc": _scan("o"),
    "scan_payments_cdc": _scan("p"),
    "scan_refunds_cdc": _scan("r"),
    "scan_behavior": _with("b", f"SELECT {BEHAVIOR}, cart_id FROM b"),
    "scan_ticks": _with("t", "SELECT * FROM t"),
    "json_tolerant_decode": _with("o", f"""
        SELECT order_id, user_id, order_status,
               CASE WHEN {ORDERS_MESSAGE} = 3 THEN NULL ELSE total_amount END AS total_amount,
               currency, coupon_id, created_at_ms, updated_at_ms, __op, __source_ts_ms
        FROM o WHERE {ORDERS_MESSAGE} IN (3, 6, 7, 8, 9, 10)
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM o WHERE {ORDERS_MESSAGE} = 4"""),
    "computed_columns": _with(
        "o", "SELECT order_id, created AS created_at, updated_at, event_time FROM o"),
    "cdc_unwrap": _with("o", """
        SELECT order_id, user_id, order_status, total_amount, currency, coupon_id,
               created_at_ms, updated_at_ms, __op, 'public' AS __schema, 'orders' AS __table,
               __source_ts_ms, CASE WHEN __op = 'd' THEN 'true' ELSE 'false' END AS __deleted
        FROM o WHERE order_id % 13 <> 0"""),
    "snapshot_bootstrap": _with("o", """
        SELECT order_id, user_id, order_status, total_amount, currency, coupon_id,
               created_at_ms, updated_at_ms,
               CASE WHEN created < TIMESTAMP '1999-01-01' THEN 'r' ELSE __op END AS __op,
               CASE WHEN created >= TIMESTAMP '1999-01-01' THEN __source_ts_ms END
                   AS __source_ts_ms
        FROM o"""),
    "snapshot_handover": """
        WITH o AS (SELECT o_orderkey AS order_id, epoch_ms(o_orderdate) AS placed,
                          CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
                          epoch_ms(TIMESTAMP '1997-01-01') AS begun,
                          epoch_ms(TIMESTAMP '1997-01-01') + (o_orderkey % 60) * 86400000
                              AS read_at FROM orders),
        log AS (SELECT *, 'c' AS __op, placed AS position FROM o
                UNION ALL SELECT *, 'u', placed + 20 * 86400000::BIGINT FROM o WHERE order_id % 3 = 0
                UNION ALL SELECT *, 'd', placed + 40 * 86400000::BIGINT FROM o WHERE order_id % 5 = 0),
        snapshot AS (SELECT * FROM o WHERE placed <= read_at
                     AND NOT (order_id % 5 = 0 AND placed + 40 * 86400000::BIGINT <= read_at))
        SELECT order_id, total_amount, 'r' AS __op, read_at AS position FROM snapshot
        UNION ALL
        SELECT order_id, total_amount, __op, position FROM log
        WHERE position > begun
          AND NOT (order_id IN (SELECT order_id FROM snapshot) AND position <= read_at)""",
    "cdc_route": _with("opr", """
        SELECT 'raw.cdc.commerce.public.orders' AS topic, order_id AS entity_id, __op FROM o
        UNION ALL SELECT 'raw.cdc.commerce.public.payments', payment_id, __op FROM p
        UNION ALL SELECT 'raw.cdc.commerce.public.refunds', refund_id, __op FROM r"""),
    "table_scan": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "query_as_dataset": _commerce("""
        SELECT window_start, metric_name, metric_value FROM kpis
        WHERE metric_value >= 100000"""),
    "bronze_orders": _bronze("o"),
    "bronze_payments": _bronze("p"),
    "bronze_refunds": _bronze("r"),
    "bronze_ticks": _with("t", BRONZE_TICKS),
    "bronze_behavior": _with("b", f"SELECT {BEHAVIOR}, cart_id FROM b"),
    "silver_order_events": _with("opr", ORDER_EVENTS),
    "silver_ticks_1s": _with("t", "SELECT * FROM bars", BARS),
    "silver_behavior": _with("b", f"SELECT {BEHAVIOR} FROM b"),
    "gold_commerce": _commerce(f"SELECT {LISTED} FROM kpis"),
    "gold_market": _market("SELECT * FROM market"),
    "kpi_unpivot": _with("t", """
        SELECT window_start, symbol, exchange, 'tick_count' AS metric_name,
               CAST(tick_count AS DOUBLE) AS metric_value FROM bars
        UNION ALL SELECT window_start, symbol, exchange, 'traded_volume', traded_volume FROM bars
        UNION ALL SELECT window_start, symbol, exchange, 'min_price', min_price FROM bars
        UNION ALL SELECT window_start, symbol, exchange, 'sell_tick_count',
                         CAST(sell_tick_count AS DOUBLE) FROM bars""", BARS),
    "filter_created": _with(
        "o", "SELECT order_id, user_id, total_amount FROM o WHERE __op = 'c'"),
    "filter_succeeded": _with(
        "p", "SELECT payment_id, user_id, amount FROM p WHERE payment_status = 'SUCCEEDED'"),
    "epoch_to_ts": _with("t", "SELECT tick_id, event_ts FROM t"),
    "event_time_coalesce": _with("r", "SELECT refund_id, event_time FROM r"),
    "ltz_to_ntz": _with(
        "b", "SELECT event_id, event_time + INTERVAL 9 HOUR AS local_time FROM b"),
    "snapshots": _commerce("""
        SELECT 'kpis-' || batch_id AS snapshot_id, committed_at, 'append' AS operation,
               added_records, 'kpis' AS writer, batch_id
        FROM (
            SELECT CAST(CASE WHEN window_start < TIMESTAMP '1997-01-01' THEN 0
                             WHEN window_start < TIMESTAMP '1999-01-01' THEN 1
                             ELSE 2 END AS BIGINT) AS batch_id,
                   count(*) AS added_records FROM kpis GROUP BY 1)
        JOIN (VALUES (0, TIMESTAMP '2026-03-13 02:00:00'), (1, TIMESTAMP '2026-03-13 02:30:00'),
                     (2, TIMESTAMP '2026-03-13 03:30:00')) AS c(id, committed_at)
          ON id = batch_id"""),
    "time_travel": _commerce(f"{TIME_TRAVEL} {NEWEST_50}"),
    "time_travel_all_rows": _commerce(TIME_TRAVEL),
    "create_tables": _with("oprt", _counts(*LAYER_COUNTS, *OTHER_COUNTS), ORDER_WINDOWS,
                           COMMERCE, BARS, MARKET_WIDE, MARKET, EVENT_UNION),
    "schema_evolution": _with("o", """
        SELECT order_id, user_id, order_status, total_amount, currency,
               CASE WHEN created >= TIMESTAMP '1999-01-01' THEN coupon_id END AS coupon_id,
               created_at_ms, updated_at_ms, __op, __source_ts_ms
        FROM o"""),
    "latest_ticks": _with(
        "t", f"SELECT * FROM ({BRONZE_TICKS}) ORDER BY event_time DESC, tick_id LIMIT 20"),
    "latest_bars": _with(
        "t", "SELECT * FROM bars ORDER BY window_start DESC, symbol, exchange LIMIT 20", BARS),
    "latest_market_kpis": _market(
        "SELECT * FROM market ORDER BY window_start DESC, symbol, metric_name LIMIT 50"),
    "latest_orders": (
        f"SELECT * FROM ({_bronze('o')}) ORDER BY cdc_source_ts DESC NULLS LAST, order_id "
        "LIMIT 20"),
    "latest_commerce_kpis": _commerce(f"SELECT {LISTED} FROM kpis {NEWEST_50}"),
    "latest_entities": _with("opr", " UNION ALL ".join((
        _newest("orders", "order_id", "order_status", "o", 2),
        _newest("payments", "payment_id", "payment_status", "p", 2),
        _newest("refunds", "refund_id", "refund_status", "r", 1)))),
    "table_counts": _with("oprt", _counts(*LAYER_COUNTS), ORDER_WINDOWS, COMMERCE, BARS,
                              MARKET_WIDE, MARKET, EVENT_UNION),
    "freshness": _both(" UNION ALL ".join((
        _lag("gold.commerce_kpis_1m", "kpis"), _lag("gold.crypto_market_kpis_1m", "market")))),
    "freshness_by_day": _both(" UNION ALL ".join((
        _lag_days("gold.commerce_kpis_1m", "kpis"),
        _lag_days("gold.crypto_market_kpis_1m", "market")))),
    "hashed_writes": _with("oprt", _hashed(
        ("bronze.orders_cdc", "o"), ("bronze.payments_cdc", "p"), ("bronze.refunds_cdc", "r"),
        ("bronze.crypto_ticks", "t"), ("bronze.user_behavior_events", "events"))),
    "processing_time": _with(
        "t", "SELECT count(*) AS stamped_rows, CAST(1 AS BIGINT) AS stamps, "
             "true AS of_this_hour FROM t"),
    "minute_floor": _with("t", "SELECT tick_id, date_trunc('minute', event_ts) AS minute FROM t"),
    "dq_commerce": _commerce(CHECK_COMMERCE, DIRTY_COMMERCE),
    "dq_market": _both(CHECK_MARKET, DIRTY_MARKET),
    "dq_checkpoint": _both(CHECKPOINT, DIRTY_COMMERCE, DIRTY_MARKET,
        f"results AS ({CHECK_COMMERCE} UNION ALL {CHECK_MARKET})"),
    "dq_rejected": _both(
        _rejected("gold_commerce_kpis_suite", "dirty_commerce", COMMERCE_NAMES, False)
        + " UNION ALL "
        + _rejected("gold_crypto_market_kpis_suite", "dirty_market", MARKET_NAMES, True),
        DIRTY_COMMERCE, DIRTY_MARKET),
    "dq_conservation": _with("opr", """
        SELECT load, bronze_rows, silver_rows, bronze_rows = silver_rows AS balanced
        FROM (SELECT 'whole' AS load, (SELECT count(*) FROM o) + (SELECT count(*) FROM p)
                     + (SELECT count(*) FROM r) AS bronze_rows,
                     (SELECT count(*) FROM order_events) AS silver_rows
              UNION ALL
              SELECT 'broken', (SELECT count(*) FROM o) + (SELECT count(*) FROM p)
                     + (SELECT count(*) FROM r),
                     (SELECT count(*) FROM o) + (SELECT count(*) FROM p))""", EVENT_UNION),
    "dq_contents": _with("opr", """
        SELECT load, entity_type, day, n AS expected_rows, n AS found_rows,
               load = 'whole' OR entity_type <> 'order' OR day NOT IN (SELECT day FROM ends)
                   AS equal
        FROM days, (VALUES ('whole'), ('swapped')) AS loads(load)""", EVENT_UNION, """
        ends AS (SELECT CAST(event_time AS DATE) AS day, min(CAST(event_id AS BIGINT)) AS first,
                        max(CAST(event_id AS BIGINT)) AS last
                 FROM order_events WHERE entity_type = 'order' AND day(event_time) = 7
                 GROUP BY 1 HAVING first < last)""", """
        days AS (SELECT entity_type, CAST(event_time AS DATE) AS day, count(*) AS n
                 FROM order_events GROUP BY ALL)"""),
    "dq_last_day": _both(CHECKPOINT, *LAST_DAY),
    "dq_history": _both(f"""
        SELECT suite, observed_rows, success
        FROM ({CHECKPOINT}), (VALUES (1), (2)) AS runs(run_id)""", *LAST_DAY),
    "catalog_listing": _with("o", """
        SELECT layer, table_name, (SELECT count(*) FROM o) AS order_records
        FROM (VALUES ('bronze', 'orders_cdc'), ('bronze', 'payments_cdc'),
                     ('bronze', 'refunds_cdc'), ('bronze', 'crypto_ticks'),
                     ('bronze', 'user_behavior_events'), ('silver', 'order_events'),
                     ('silver', 'crypto_ticks_1s'), ('silver', 'user_behavior'),
                     ('gold', 'commerce_kpis_1m'), ('gold', 'crypto_market_kpis_1m'),
                     ('gold', 'behavior_kpis_1m')) AS t(layer, table_name)"""),
    "latest_behavior_kpis": """
        SELECT ts AS window_start, ts AS window_end, event_type AS metric_name,
               value AS metric_value FROM events WHERE false""",
    "dashboard_rows": _with(
        "t", f"SELECT * FROM ({BRONZE_TICKS}) ORDER BY event_time DESC, tick_id LIMIT 5000"),
    "silver_ticks_1s_double": _with("t", f"""
        SELECT window_start, window_end, symbol, exchange, tick_count, buy_tick_count,
               sell_tick_count, {", ".join(
                   f"CAST({c} AS DECIMAL(25,8)) AS {c}" for c in BAR_VALUES)}
        FROM bars""", BARS),
    "gold_market_double": _market("""
        SELECT window_start, window_end, symbol, metric_name,
               CAST(metric_value AS DECIMAL(25,8)) AS metric_value FROM market"""),
    "gold_commerce_seoul": _commerce("""
        SELECT window_start + INTERVAL 9 HOUR AS window_start,
               window_end + INTERVAL 9 HOUR AS window_end, metric_name, metric_value FROM kpis"""),
    "backfill_ranges": _both(f"""
        SELECT {LISTED}, NULL AS symbol FROM kpis
        UNION ALL SELECT {LISTED}, symbol FROM market"""),
    "stream_restart": _bronze("o"),
    "stream_market_chained": _with("t", f"""
        SELECT window_start, symbol, exchange, n.metric_name, n.metric_value
        FROM (SELECT * FROM bars
              WHERE {_window('window_start', 'minute')} + INTERVAL 1 MINUTE <=
                    (SELECT max(event_ts) - INTERVAL 5 SECOND FROM t)),
             unnest([{{'metric_name': 'tick_count', 'metric_value': tick_count::DOUBLE}},
                     {{'metric_name': 'traded_volume', 'metric_value': traded_volume}},
                     {{'metric_name': 'min_price', 'metric_value': min_price}},
                     {{'metric_name': 'sell_tick_count', 'metric_value': sell_tick_count::DOUBLE}}
                    ]) AS u(n)
        UNION ALL SELECT window_start, symbol, NULL, metric_name, metric_value
        {_closed('market', 't', 'event_ts')}""", BARS, MARKET_WIDE, MARKET),
    "backfill_strays": _with("or", """
        SELECT 'orders' AS feed, count(*) AS records,
               count(*) FILTER (order_id % 97 = 0) AS event_before_record,
               0::BIGINT AS event_after_record, 0::BIGINT AS over_a_day,
               max(CASE WHEN order_id % 97 = 0 THEN 10800000 END)::BIGINT AS farthest_ms FROM o
        UNION ALL
        SELECT 'refunds', count(*), 0, count(*) FILTER (refund_id % 89 = 0),
               count(*) FILTER (refund_id % 89 = 0),
               max(CASE WHEN refund_id % 89 = 0 THEN 180000000 END)::BIGINT FROM r"""),
    "commit_group": _with("o", """
        SELECT state, table_name, count(*) AS row_count
        FROM (VALUES ('bronze.orders_cdc'), ('silver.order_events')) AS names(table_name),
             (SELECT 'retry' AS state FROM o
              UNION ALL SELECT 'crash' FROM o WHERE created < TIMESTAMP '1999-01-01')
        GROUP BY ALL"""),
    "load_layers": _with("oprt", _counts(*LAYER_COUNTS), ORDER_WINDOWS, COMMERCE, BARS,
                         MARKET_WIDE, MARKET, EVENT_UNION),
    "stream_late_rows": _with(
        "t", f"SELECT * {_closed('market', 't', 'event_ts')}",
        MARKET_WIDE.replace("FROM t)", f"FROM t WHERE NOT ({LATE}))"), MARKET),
    # The closed windows of the late rows' stream, and those that its watermark has not passed.
    "stream_dropped_rows": _with("t", f"""
        SELECT job, count(*) AS rows, count(*) FILTER (NOT late AND closed) AS closed_rows,
               count(*) FILTER (NOT late AND NOT closed) AS open_rows,
               count(*) FILTER (late) AS dropped_rows
        FROM (SELECT job, {LATE} AS late, time_bucket(size, event_ts) + size <= (
                  SELECT max(event_ts) - INTERVAL 5 SECOND FROM t) AS closed
              FROM t, (VALUES ('ticks_kpis_1m', INTERVAL 1 MINUTE),
                              ('ticks_bars_1s', INTERVAL 1 SECOND)) AS jobs(job, size))
        GROUP BY job"""),
    "stream_rejects": _with("o", """
        SELECT 'orders_rows' AS job, 0::BIGINT AS missing_batches, count(*) AS records,
               count(*) FILTER (order_id % 11 <> 0) AS rows,
               count(*) FILTER (order_id % 11 = 0) AS rejects, 0::BIGINT AS dropped_groups
        FROM o"""),
    "stream_idle_feed": _with("opr", " UNION ALL ".join((
        f"SELECT {LISTED} {_closed('kpis', 'o', 'event_time')} "
        "AND metric_name IN ('orders_created', 'gross_order_value')",
        f"SELECT {LISTED} {_closed('kpis', EARLY_PAYMENTS, 'event_time')} "
        "AND metric_name = 'payments_succeeded'")),
        ORDER_WINDOWS, COMMERCE.replace("FROM p ", f"FROM {EARLY_PAYMENTS} ")),
    "stream_bronze_orders": _bronze("o"),
    "stream_bronze_ticks": _with("t", BRONZE_TICKS),
    "stream_silver_order_events": _with("opr", ORDER_EVENTS),
    "stream_silver_behavior": _with("b", f"SELECT {BEHAVIOR} FROM b"),
    "stream_silver_ticks_1s": _with("t", f"SELECT * {_closed('bars', 't', 'event_ts')}", BARS),
    "stream_gold_market": _market(f"SELECT * {_closed('market', 't', 'event_ts')}"),
    "stream_gold_commerce": _commerce(" UNION ALL ".join((
        f"SELECT {LISTED} {_closed('kpis', 'o', 'event_time')} "
        "AND metric_name IN ('orders_created', 'gross_order_value')",
        f"SELECT {LISTED} {_closed('kpis', 'p', 'event_time')} "
        "AND metric_name = 'payments_succeeded'",
        f"SELECT {LISTED} {_closed('kpis', 'r', 'event_time')} "
        "AND metric_name = 'refund_amount'"))),
}
