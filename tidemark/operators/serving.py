"""Reads that serve dashboards: newest rows, counts, freshness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import hour_floor, millis_between

# Size of stored lag sketches: a percentile's rank is off by at most RANK_ERROR, but for about
# one sketch in a hundred. Groups of fewer rows than K are exact.
K, RANK_ERROR = 800, 0.005

ROW_LIMIT = 5000  # rows a dashboard query returns unless it asks for another number

# Table to (sort columns, row limit). A leading "-" means newest first. Where the listed
# order leaves ties, the last column breaks them, so the kept rows are determined.
LATEST = {
    "bronze.crypto_ticks": (("-event_time", "tick_id"), 20),
    "silver.crypto_ticks_1s": (("-window_start", "symbol", "exchange"), 20),
    "gold.crypto_market_kpis_1m": (("-window_start", "symbol", "metric_name"), 50),
    "bronze.orders_cdc": (("-cdc_source_ts", "order_id"), 20),
    "gold.commerce_kpis_1m": (("-window_start", "metric_name"), 50),
    "gold.behavior_kpis_1m": (("-window_start", "metric_name"), 50),
}


def ordered(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Sort with NULLs last in either direction."""
    return df.orderBy(*[
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
        for c in columns
    ])


def latest(df: DataFrame, table: str, limit: int | None = None) -> DataFrame:
    """Newest rows of ``table``: a per-partition top-k, then one merge of the survivors."""
    columns, default = LATEST[table]
    return ordered(df, columns).limit(default if limit is None else limit)


def dashboard_rows(df: DataFrame, table: str, limit: int = ROW_LIMIT) -> DataFrame:
    """Newest rows of ``table`` as a dashboard shows them."""
    return latest(df, table, limit)


def latest_per_entity(orders: DataFrame, payments: DataFrame, refunds: DataFrame,
                      limits: tuple[int, int, int] = (2, 2, 1)) -> DataFrame:
    """Rows with the highest keys of each entity table, tagged with the entity."""
    def newest(df: DataFrame, entity: str, key: str, status: str, stamp: str,
               limit: int) -> DataFrame:
        rows = df.select(
            F.lit(entity).alias("entity"), F.col(key).alias("id"),
            F.col(status).alias("status"), F.col(stamp).alias("event_ts"))
        return ordered(rows, ("-id", "-event_ts", "status")).limit(limit)

    return (
        newest(orders, "orders", "order_id", "order_status", "created_at", limits[0])
        .unionByName(newest(payments, "payments", "payment_id", "payment_status", "paid_at",
                            limits[1]))
        .unionByName(newest(refunds, "refunds", "refund_id", "refund_status", "refunded_at",
                            limits[2]))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` per table. Each count reads file footers only."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def freshness(tables: dict[str, DataFrame], target_ms: int = 5000) -> DataFrame:
    """How long after its window closed each row was produced, per table, in milliseconds.

    The percentile is an approximate sketch of fixed size, so no group is held whole.
    """
    def lag(name: str, df: DataFrame) -> DataFrame:
        return df.select(
            F.lit(name).alias("table_name"),
            millis_between(F.col("window_end"), F.col("produced_at")).alias("lag_ms"))

    rows = reduce(lambda a, b: a.unionByName(b), [lag(n, d) for n, d in tables.items()])
    return rows.groupBy("table_name").agg(
        F.count("*").alias("measured_rows"),
        F.avg("lag_ms").alias("avg_lag_ms"),
        F.max("lag_ms").alias("max_lag_ms"),
        F.percentile_approx("lag_ms", 0.95).alias("p95_lag_ms"),
        F.sum(F.when(F.col("lag_ms") <= target_ms, 1).otherwise(0)).alias("rows_in_target"),
    )


def lag_sketches(rows: DataFrame, keys: list[Column | str], target_ms: int = 5000) -> DataFrame:
    """What ``freshness`` measures, per ``keys`` and hour of ``window_end``, in a form that adds
    up: counts, sums and a quantile sketch of fixed size."""
    lag = millis_between(F.col("window_end"), F.col("produced_at"))
    timed = rows.select(*keys, hour_floor(F.col("window_end")).alias("hour"), lag.alias("lag"))
    names = [c for c in timed.columns if c != "lag"]
    return timed.groupBy(*names).agg(
        F.count("*").alias("measured_rows"),
        F.count("lag").alias("timed_rows"),
        F.sum("lag").alias("lag_ms"),
        F.max("lag").alias("max_lag_ms"),
        F.count_if(F.col("lag") <= target_ms).alias("rows_in_target"),
        F.kll_sketch_agg_bigint("lag", K).alias("lags"),
    )


def merged_freshness(hours: DataFrame, *keys: Column | str, percentile: float = 0.95) -> DataFrame:
    """Rows of ``lag_sketches`` merged per ``keys``. Rows without both times count as measured
    and have no lag; a group of nothing else has NULL lags."""
    merged = hours.groupBy(*keys).agg(
        F.sum("measured_rows").alias("measured_rows"),
        F.sum("timed_rows").alias("timed_rows"),
        (F.sum("lag_ms") / F.sum("timed_rows")).alias("avg_lag_ms"),
        F.max("max_lag_ms").alias("max_lag_ms"),
        F.sum("rows_in_target").alias("rows_in_target"),
        F.kll_merge_agg_bigint("lags", K).alias("lags"),
    )
    quantile = F.kll_sketch_get_quantile_bigint("lags", F.lit(percentile))
    return merged.withColumn(
        "percentile_ms", F.when(F.col("timed_rows") > 0, quantile)).drop("lags")
