"""Freshness kept per batch and hour, so that a day's percentile needs no rows read again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.serving import lag_sketches, merged_freshness
from tidemark.plans.lake import Lake

TABLE, WRITER = "ops.freshness_hours", "freshness"
TABLES = ("silver.crypto_ticks_1s", "gold.crypto_market_kpis_1m", "gold.commerce_kpis_1m")


def measure(lake: Lake, tables: tuple[str, ...] = TABLES) -> bool:
    """Sketch the lags of batches that were committed since the last call; False if there were
    none. One caller at a time; a call that broke off is done again by the next one.

    Lags are differences of wall-clock times: where a clock is set within them, they are off
    by as much.
    """
    seen = lake.read(TABLE).select(
        "table_name", F.col("source_writer").alias("writer"), F.col("source_batch").alias("batch_id"))

    def sketches(table: str) -> DataFrame:
        done = seen.where(F.col("table_name") == table).select("writer", "batch_id").distinct()
        keys = [F.lit(table).alias("table_name"), F.col("writer").alias("source_writer"),
                F.col("batch_id").alias("source_batch")]
        return lag_sketches(lake.unseen(table, done), keys)

    last = lake.committed(TABLE).get(WRITER, -1)
    rows = reduce(lambda a, b: a.unionByName(b), map(sketches, tables))
    lake.append(rows, TABLE, WRITER, last + 1)
    return lake.committed(TABLE).get(WRITER, -1) > last


def by_day(lake: Lake, percentile: float = 0.95) -> DataFrame:
    """Freshness per table and day of the window's end, from the stored sketches alone."""
    day = F.col("hour").cast("date").alias("day")
    return merged_freshness(lake.read(TABLE), "table_name", day, percentile=percentile)
