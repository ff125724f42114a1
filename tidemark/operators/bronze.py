"""Raw layer: every record of a feed, with stored times. Nothing is filtered or merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import epoch_ms_to_ts, processing_time, to_wall_clock, wall_clock
from tidemark.operators.layout import conform

CHANGE_TABLES = {
    "orders": ("bronze.orders_cdc", "created_at"),
    "payments": ("bronze.payments_cdc", "paid_at"),
    "refunds": ("bronze.refunds_cdc", "refunded_at"),
}


def bronze_changes(df: DataFrame, feed: str, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """Change records of ``feed`` with the operation and source time renamed."""
    table, stamp = CHANGE_TABLES[feed]
    return conform(df.withColumns({
        stamp: wall_clock(df, stamp, zone),
        "updated_at": wall_clock(df, "updated_at", zone),
        "cdc_op": F.col("__op"),
        "cdc_source_ts": to_wall_clock(epoch_ms_to_ts("__source_ts_ms"), zone),
        "ingest_time": processing_time(zone),
    }), table)


def bronze_ticks(df: DataFrame, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    return conform(df.withColumns({
        "event_time": wall_clock(df, "event_ts", zone),
        "ingest_time": processing_time(zone),
    }), "bronze.crypto_ticks")


def bronze_behavior(df: DataFrame, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    return conform(df.withColumns({
        "event_time": wall_clock(df, "event_time", zone),
        "ingest_time": processing_time(zone),
    }), "bronze.user_behavior_events")
