"""Normalised layer: one event shape for all commerce entities, and one-second bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import (
    count_where,
    mean,
    processing_time,
    ratio_or_zero,
    wall_clock,
)
from tidemark.operators.layout import conform
from tidemark.operators.windows import tumble

# Feed to (entity tag, key, status column, amount column).
ENTITIES = {
    "orders": ("order", "order_id", "order_status", "total_amount"),
    "payments": ("payment", "payment_id", "payment_status", "amount"),
    "refunds": ("refund", "refund_id", "refund_status", "refund_amount"),
}
SOURCE_SYSTEM = "postgres_cdc"


def entity_events(df: DataFrame, feed: str, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """Change records of one feed in the common event shape."""
    entity, key, status, amount = ENTITIES[feed]
    return conform(df.select(
        F.col(key).cast("string").alias("event_id"),
        "user_id",
        F.lit(entity).alias("entity_type"),
        F.col(status).alias("event_status"),
        F.col(amount).alias("amount"),
        wall_clock(df, "event_time", zone).alias("event_time"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        processing_time(zone).alias("ingest_time"),
    ), "silver.order_events")


def order_events(orders: DataFrame, payments: DataFrame, refunds: DataFrame,
                 zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """All change records of the three entities. One row per record, duplicates included."""
    return (
        entity_events(orders, "orders", zone)
        .unionByName(entity_events(payments, "payments", zone))
        .unionByName(entity_events(refunds, "refunds", zone))
    )


def bar_aggregates() -> list[Column]:
    return [
        F.count("*").alias("tick_count"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        mean("price").alias("avg_price"),
        F.sum("volume").alias("traded_volume"),
        F.sum("trade_notional").alias("traded_notional"),
        ratio_or_zero("trade_notional", "volume").alias("vwap"),
        count_where(F.col("side") == "BUY").alias("buy_tick_count"),
        count_where(F.col("side") == "SELL").alias("sell_tick_count"),
    ]


def stored_bars(bars: DataFrame, zone: str) -> DataFrame:
    return conform(bars.withColumn("produced_at", processing_time(zone)),
                   "silver.crypto_ticks_1s")


def tick_bars(ticks: DataFrame, zone: str = schemas.LOCAL_ZONE, time: str = "event_ts",
              size: str = "1 second") -> DataFrame:
    """Per symbol and exchange: counts, price range and mean, volume, notional, VWAP."""
    return stored_bars(tumble(ticks, time, size, ["symbol", "exchange"], bar_aggregates(), zone),
                       zone)


def silver_behavior(bronze: DataFrame) -> DataFrame:
    """Behaviour events without the cart column."""
    return conform(bronze, "silver.user_behavior")
