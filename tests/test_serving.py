from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import feed, order, payment, refund, values

from tidemark import schemas
from tidemark.operators import (
    freshness,
    lag_sketches,
    latest,
    latest_per_entity,
    merged_freshness,
    table_counts,
)
from tidemark.operators.serving import RANK_ERROR, ROW_LIMIT, dashboard_rows
from tidemark.plans.freshness import TABLE, by_day, measure

START = datetime(2026, 3, 13, 12, 0)


def kpis(spark, rows):
    return spark.createDataFrame(
        [(w, w + timedelta(minutes=1) if w else None, n, float(v), p) for w, n, v, p in rows],
        schemas.table_schema("gold.commerce_kpis_1m"))


def test_latest_breaks_ties_and_puts_nulls_last(spark):
    rows = [(START + timedelta(minutes=i % 30), f"m{i}", i, None) for i in range(90)]
    df = kpis(spark, [*rows, (None, "none", 0, None)])
    got = latest(df, "gold.commerce_kpis_1m").collect()
    assert len(got) == 50
    want = sorted(rows, key=lambda r: (-r[0].timestamp(), r[1]))[:50]
    assert [(r["window_start"], r["metric_name"]) for r in got] == [r[:2] for r in want]
    everything = latest(df, "gold.commerce_kpis_1m", limit=1000).collect()
    assert everything[-1]["window_start"] is None


def test_latest_is_a_top_k_of_as_many_rows_as_asked_for(spark):
    df = spark.range(6000).select(
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("window_start"),
        F.lit("m").alias("metric_name"))
    plan = latest(df, "gold.commerce_kpis_1m")._jdf.queryExecution()
    assert "TakeOrderedAndProject(limit=50" in plan.executedPlan().toString()
    assert latest(df, "gold.commerce_kpis_1m", limit=5500).count() == 5500
    assert dashboard_rows(df, "gold.commerce_kpis_1m").count() == ROW_LIMIT == 5000


def test_latest_orders_ties_by_key(spark):
    ts = datetime(2026, 3, 13, 12, 0)
    df = spark.createDataFrame([(i, ts) for i in range(40)], "order_id bigint, cdc_source_ts timestamp_ntz")
    assert [r["order_id"] for r in latest(df, "bronze.orders_cdc").collect()] == list(range(20))


def test_newest_rows_per_entity(spark):
    got = latest_per_entity(
        feed(spark, "orders", [order(i, 5, i) for i in (3, 1, 2)]),
        feed(spark, "payments", [payment(i, 5, i) for i in (5, 4)]),
        feed(spark, "refunds", [refund(i, 5, i) for i in (8, 9)]))
    assert got.columns == ["entity", "id", "status", "event_ts"]
    assert values(got, "entity", "id") == [
        ("orders", 2), ("orders", 3), ("payments", 4), ("payments", 5), ("refunds", 9)]


def test_counts(spark):
    got = table_counts({"a": spark.range(3), "b": spark.range(0)})
    assert values(got) == [("a", 3), ("b", 0)]


def test_freshness(spark):
    end = START + timedelta(minutes=1)
    df = kpis(spark, [(START, "m", 1, end + timedelta(milliseconds=m)) for m in (1000, 3000, 11000)])
    row = freshness({"t": df}).first()
    assert (row["measured_rows"], row["max_lag_ms"], row["rows_in_target"]) == (3, 11000, 2)
    assert row["avg_lag_ms"] == pytest.approx(5000) and row["p95_lag_ms"] == 11000
    assert freshness({"t": df.where(F.lit(False))}).count() == 0


def test_merged_sketches_are_within_the_rank_error(spark):
    """40,000 lags of four days in 96 hourly sketches; one lag has a third of all rows."""
    rows = spark.range(40_000).select(
        F.timestamp_add("SECOND", (F.col("id") * 8).cast("int"),
                        F.lit(START).cast("timestamp_ntz")).alias("window_end"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)))
        .alias("lag"))
    rows = rows.withColumn("produced_at", F.timestamp_add("SECOND", F.col("lag").cast("int"),
                                                          F.col("window_end")))
    hours = lag_sketches(rows, [])
    assert hours.count() == 89
    lags = sorted(r[0] * 1000 for r in rows.select("lag").collect())
    for percentile in (0.05, 0.5, 0.95, 0.99):
        got = merged_freshness(hours, percentile=percentile).first()
        below = sum(v < got.percentile_ms for v in lags) / len(lags)
        upto = sum(v <= got.percentile_ms for v in lags) / len(lags)
        assert below - RANK_ERROR <= percentile <= upto + RANK_ERROR
    assert (got.measured_rows, got.timed_rows, got.max_lag_ms) == (40_000, 40_000, lags[-1])
    assert got.avg_lag_ms == pytest.approx(sum(lags) / len(lags))


def test_freshness_takes_each_batch_once(spark, lake):
    table, tables = "gold.commerce_kpis_1m", ("gold.commerce_kpis_1m",)
    late = [(START + timedelta(days=d), f"m{m}", 1, START + timedelta(days=d, seconds=60 + m))
            for d in (0, 1) for m in (1, 2, 9)]
    assert not measure(lake, tables)
    lake.append(kpis(spark, late[:4]), table, "a", 0)
    assert measure(lake, tables) and not measure(lake, tables)
    lake.append(kpis(spark, late[4:]), table, "b", 0)
    lake.append(kpis(spark, [(START, "x", 1, None), (None, "y", 1, START)]), table, "a", 1)
    assert measure(lake, tables)
    assert lake.read(TABLE).select("source_writer", "source_batch").distinct().count() == 3
    got = {r.day and r.day.day: r for r in by_day(lake).collect()}
    assert [(d, r.measured_rows, r.timed_rows, r.max_lag_ms, r.rows_in_target, r.percentile_ms)
            for d, r in sorted(got.items(), key=lambda x: x[0] or 0)] == [
        (None, 1, 0, None, 0, None), (13, 4, 3, 9000, 2, 9000), (14, 3, 3, 9000, 2, 9000)]
    assert got[13].avg_lag_ms == 4000
