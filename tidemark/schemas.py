"""Feed and table layouts.

Every reader and writer takes its schema from here, so nothing is ever inferred.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Names, types and order must equal the feeds and tables that
# existing producers write and existing SQL reads.
# --------------------------------------------------------------------------

LOCAL_ZONE = "Asia/Seoul"

LAYERS = ("bronze", "silver", "gold")

TOPICS = {
    "orders": "raw.cdc.commerce.public.orders",
    "payments": "raw.cdc.commerce.public.payments",
    "refunds": "raw.cdc.commerce.public.refunds",
    "behavior": "raw.event.commerce.user_behavior_v3",
    "ticks": "raw.event.market.crypto_ticks_v1",
}

TOPIC_PREFIX = "raw.cdc.commerce"
CAPTURED_TABLES = ("public.orders", "public.payments", "public.refunds")

WATERMARKS = {
    "orders": "5 seconds",
    "payments": "5 seconds",
    "refunds": "5 seconds",
    "behavior": "10 seconds",
    "ticks": "5 seconds",
}

FEED_DDL = {
    "orders": """
        order_id BIGINT, user_id BIGINT, order_status STRING, total_amount DECIMAL(12,2),
        currency STRING, coupon_id STRING, created_at_ms BIGINT, updated_at_ms BIGINT,
        __op STRING, __source_ts_ms BIGINT""",
    "payments": """
        payment_id BIGINT, order_id BIGINT, user_id BIGINT, payment_status STRING,
        payment_method STRING, amount DECIMAL(12,2), paid_at_ms BIGINT, updated_at_ms BIGINT,
        __op STRING, __source_ts_ms BIGINT""",
    "refunds": """
        refund_id BIGINT, order_id BIGINT, payment_id BIGINT, user_id BIGINT,
        refund_status STRING, refund_reason STRING, refund_amount DECIMAL(12,2),
        refunded_at_ms BIGINT, updated_at_ms BIGINT, __op STRING, __source_ts_ms BIGINT""",
    "behavior": """
        event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, page STRING,
        product_id BIGINT, keyword STRING, cart_id STRING, order_id BIGINT, quantity INT,
        price DOUBLE, device_type STRING, source STRING""",
    "ticks": """
        tick_id STRING, symbol STRING, exchange STRING, price DOUBLE, volume DOUBLE,
        side STRING, trade_id STRING, ingest_source STRING, event_time BIGINT""",
}

# Columns the event feeds declare as always present.
REQUIRED = {
    "behavior": (
        "event_id", "user_id", "session_id", "event_type", "page", "device_type", "source",
    ),
    "ticks": (
        "tick_id", "symbol", "exchange", "price", "volume", "side", "trade_id",
        "ingest_source", "event_time",
    ),
}

TABLE_DDL = {
    "bronze.orders_cdc": """
        order_id BIGINT, user_id BIGINT, order_status STRING, total_amount DECIMAL(12,2),
        currency STRING, coupon_id STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
        cdc_op STRING, cdc_source_ts TIMESTAMP_NTZ, ingest_time TIMESTAMP_NTZ""",
    "bronze.payments_cdc": """
        payment_id BIGINT, order_id BIGINT, user_id BIGINT, payment_status STRING,
        payment_method STRING, amount DECIMAL(12,2), paid_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ, cdc_op STRING, cdc_source_ts TIMESTAMP_NTZ,
        ingest_time TIMESTAMP_NTZ""",
    "bronze.refunds_cdc": """
        refund_id BIGINT, order_id BIGINT, payment_id BIGINT, user_id BIGINT,
        refund_status STRING, refund_reason STRING, refund_amount DECIMAL(12,2),
        refunded_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, cdc_op STRING,
        cdc_source_ts TIMESTAMP_NTZ, ingest_time TIMESTAMP_NTZ""",
    "bronze.user_behavior_events": """
        event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, page STRING,
        product_id BIGINT, keyword STRING, cart_id STRING, order_id BIGINT, quantity INT,
        price DOUBLE, device_type STRING, source STRING, event_time TIMESTAMP_NTZ,
        ingest_time TIMESTAMP_NTZ""",
    "bronze.crypto_ticks": """
        tick_id STRING, symbol STRING, exchange STRING, price DOUBLE, volume DOUBLE,
        side STRING, trade_id STRING, trade_notional DOUBLE, ingest_source STRING,
        event_time TIMESTAMP_NTZ, ingest_time TIMESTAMP_NTZ""",
    "silver.order_events": """
        event_id STRING, user_id BIGINT, entity_type STRING, event_status STRING,
        amount DECIMAL(12,2), event_time TIMESTAMP_NTZ, source_system STRING,
        ingest_time TIMESTAMP_NTZ""",
    "silver.crypto_ticks_1s": """
        window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, symbol STRING, exchange STRING,
        tick_count BIGINT, min_price DOUBLE, max_price DOUBLE, avg_price DOUBLE,
        traded_volume DOUBLE, traded_notional DOUBLE, vwap DOUBLE, buy_tick_count BIGINT,
        sell_tick_count BIGINT, produced_at TIMESTAMP_NTZ""",
    "silver.user_behavior": """
        event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, page STRING,
        product_id BIGINT, keyword STRING, order_id BIGINT, quantity INT, price DOUBLE,
        device_type STRING, source STRING, event_time TIMESTAMP_NTZ,
        ingest_time TIMESTAMP_NTZ""",
    "gold.crypto_market_kpis_1m": """
        window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, symbol STRING,
        metric_name STRING, metric_value DOUBLE, produced_at TIMESTAMP_NTZ""",
    "gold.commerce_kpis_1m": """
        window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, metric_name STRING,
        metric_value DOUBLE, produced_at TIMESTAMP_NTZ""",
    "gold.behavior_kpis_1m": """
        window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, metric_name STRING,
        metric_value DOUBLE, produced_at TIMESTAMP_NTZ""",
}

ORDER_METRICS = ("orders_created", "gross_order_value")
PAYMENT_METRICS = ("payments_succeeded",)
REFUND_METRICS = ("refund_amount",)
COMMERCE_METRICS = ORDER_METRICS + PAYMENT_METRICS + REFUND_METRICS
MARKET_METRICS = (
    "tick_count_1m",
    "traded_volume_1m",
    "traded_notional_1m",
    "vwap_1m",
    "price_volatility_1m",
)

# Avro record layouts of the two event feeds, field name to Avro type.
AVRO_RECORDS = {
    "behavior": ("UserBehaviorEvent", {
        "event_id": "string", "user_id": "long", "session_id": "string",
        "event_type": "string", "page": "string", "product_id": ["null", "long"],
        "keyword": ["null", "string"], "cart_id": ["null", "string"],
        "order_id": ["null", "long"], "quantity": ["null", "int"],
        "price": ["null", "double"], "device_type": "string", "source": "string",
        "event_time": "long",
    }),
    "ticks": ("CryptoTickEvent", {
        "tick_id": "string", "symbol": "string", "exchange": "string", "price": "double",
        "volume": "double", "side": "string", "trade_id": "string",
        "ingest_source": "string", "event_time": "long",
    }),
}

# --------------------------------------------------------------------------
# End of fixed values. The tables of quality results and of jobs are this library's own.
# --------------------------------------------------------------------------

QUALITY_DDL = "suite STRING, observed_rows BIGINT, success BOOLEAN, checked_at TIMESTAMP_NTZ"
BATCHES_DDL = """
    job STRING, run_id STRING, batch BIGINT, started_at TIMESTAMP_NTZ, duration_ms BIGINT,
    records BIGINT, rows BIGINT, watermark TIMESTAMP_NTZ, dropped_groups BIGINT,
    state_rows BIGINT"""
LAGS_DDL = """
    table_name STRING, source_writer STRING, source_batch BIGINT, hour TIMESTAMP_NTZ,
    measured_rows BIGINT, timed_rows BIGINT, lag_ms BIGINT, max_lag_ms BIGINT,
    rows_in_target BIGINT, lags BINARY"""
OWN_DDL = {
    "quality.results": QUALITY_DDL,
    "ops.job_batches": BATCHES_DDL,
    "ops.freshness_hours": LAGS_DDL,
}


@cache
def parse(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def feed_schema(feed: str) -> T.StructType:
    return parse(FEED_DDL[feed])


def table_schema(table: str) -> T.StructType:
    return parse(OWN_DDL[table] if table in OWN_DDL else TABLE_DDL[table])


def envelope_schema(row: T.StructType) -> T.StructType:
    """Layout of a change envelope around ``row``."""
    return T.StructType([
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("op", T.StringType()),
        T.StructField("source", T.StructType([
            T.StructField("schema", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ])),
    ])
