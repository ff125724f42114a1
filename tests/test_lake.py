from __future__ import annotations

import time
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import feed, order, payment, refund, tick, values

from tidemark import schemas
from tidemark.operators import (
    bronze_changes,
    bronze_ticks,
    commerce_kpis,
    latest,
    market_kpis,
    order_events,
    tick_bars,
)
from tidemark.plans import catalog
from tidemark.plans.backfill import StraysError, backfill
from tidemark.plans.lake import Lake, sliced

KPIS = "gold.commerce_kpis_1m"
DAY = "first_day=2026-03-13/last_day=2026-03-13"


def kpi_rows(spark, *items):
    return spark.createDataFrame(
        [(datetime(2026, 3, 13, 12, m), datetime(2026, 3, 13, 12, m + 1), name, float(v), None)
         for m, name, v in items], schemas.table_schema(KPIS))


def test_a_repeated_batch_is_not_written_twice(spark, lake):
    df = kpi_rows(spark, (0, "orders_created", 1))
    assert lake.append(df, KPIS, "orders", 0)
    assert not lake.append(df, KPIS, "orders", 0)
    assert not lake.append(kpi_rows(spark, (0, "orders_created", 9)), KPIS, "orders", 0)
    assert values(lake.read(KPIS), "metric_value") == [(1.0,)]
    assert lake.snapshots(KPIS).count() == 1


def test_a_batch_that_was_not_committed_is_invisible_and_replaced_on_retry(spark, lake):
    lake.append(kpi_rows(spark, (0, "orders_created", 1)), KPIS, "orders", 0)
    broken = f"{lake._leaf(lake.data_path(KPIS), 'orders', 1)}/{DAY}"
    kpi_rows(spark, (1, "orders_created", 99), (2, "orders_created", 99)).write.parquet(broken)
    assert lake.read(KPIS).count() == 1
    lake.append(kpi_rows(spark, (1, "orders_created", 2)), KPIS, "orders", 1)
    assert values(lake.read(KPIS), "metric_value") == [(1.0,), (2.0,)]


def test_a_batch_without_rows_makes_no_snapshot(spark, lake):
    assert lake.append(kpi_rows(spark), KPIS, "orders", 0)
    assert lake.snapshots(KPIS).count() == 0 and lake.read(KPIS).count() == 0
    lake.append(kpi_rows(spark, (0, "orders_created", 1)), KPIS, "orders", 1)
    assert lake.append(kpi_rows(spark), KPIS, "orders", 2)
    assert lake.committed(KPIS) == {"orders": 1}
    assert lake.read(KPIS).count() == 1


def test_writers_share_a_table(spark, lake):
    lake.append(kpi_rows(spark, (0, "orders_created", 1)), KPIS, "orders", 0)
    lake.append(kpi_rows(spark, (0, "refund_amount", 5)), KPIS, "refunds", 0)
    lake.append(kpi_rows(spark, (1, "refund_amount", 6)), KPIS, "refunds", 1)
    assert lake.committed(KPIS) == {"orders": 0, "refunds": 1}
    assert lake.read(KPIS).count() == 3


def test_reads_as_of_each_commit_are_growing_prefixes(spark, seoul_lake):
    lake = seoul_lake
    for i, when in enumerate(("11:00", "12:00", "13:00")):
        at = F.lit(f"2026-03-13 {when}:00 Asia/Seoul")
        lake.append(kpi_rows(spark, (i, "orders_created", i)), KPIS, "orders", i, at)
    counts = [lake.read(KPIS, f"2026-03-13 {t} Asia/Seoul").count()
              for t in ("10:59:59", "11:00:00", "12:30:00", "13:00:00")]
    assert counts == [0, 1, 2, 3]
    assert lake.read(KPIS, "2026-03-13 03:00:00 UTC").count() == 2
    assert lake.read(KPIS).count() == 3
    listed = lake.snapshots(KPIS).collect()
    assert [r["snapshot_id"] for r in listed] == ["orders-2", "orders-1", "orders-0"]
    assert {r["added_records"] for r in listed} == {1} and {r["operation"] for r in listed} == {"append"}


def test_reads_prune_folders_and_join_nothing(spark, lake):
    for i in range(3):
        lake.append(kpi_rows(spark, (i, "orders_created", i)), KPIS, "orders", i,
                    datetime(2026, 1, 1 + i))
    df = lake.read(KPIS, datetime(2026, 1, 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert "batch_id" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert df.count() == 2


def test_unwritten_tables_read_empty(lake):
    assert lake.read("gold.behavior_kpis_1m").count() == 0
    assert lake.snapshots("gold.behavior_kpis_1m").count() == 0
    assert lake.committed(KPIS) == {}


def test_files_from_before_a_column_was_added(spark, lake):
    table = "bronze.orders_cdc"
    rows = bronze_changes(feed(spark, "orders", [order(1, 5, 0, coupon="A")]), "orders")
    lake.append(rows, table, "orders", 0)
    old = f"{lake._leaf(lake.data_path(table), 'orders', 0)}/{DAY}"
    rows.drop("coupon_id").write.mode("overwrite").parquet(old)
    lake.append(rows, table, "orders", 1)
    assert values(lake.read(table), "coupon_id") == [("A",), (None,)]


def test_writer_names_are_checked(spark, lake):
    with pytest.raises(ValueError, match="writer name"):
        lake.append(kpi_rows(spark), KPIS, "a/../b", 0)


def test_raw_writes_can_be_hashed_over_files_even_for_one_hot_key(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "l"), "UTC", files_per_batch=4)
    rows = [order(1, 5, i) for i in range(400)]  # one order has every record
    lake.append(bronze_changes(feed(spark, "orders", rows), "orders", "UTC"),
                "bronze.orders_cdc", "orders", 0)
    sizes = lake.read("bronze.orders_cdc").groupBy(F.spark_partition_id()).count().collect()
    files = {f for f in lake.read("bronze.orders_cdc").inputFiles()}
    assert len(files) == 4 and sum(r["count"] for r in sizes) == 400


def load(spark, lake, run="a", **bounds):
    feeds = {
        "orders": feed(spark, "orders", [order(1, "89.90", 0), order(2, 245, 70), order(3, 1, 75, op="u")]),
        "payments": feed(spark, "payments", [payment(1, "89.90", 1), payment(2, 245, 71)]),
        "refunds": feed(spark, "refunds", [refund(1, "89.90", 2)]),
        "ticks": feed(spark, "ticks", [tick(i, 10 + i % 5, 1 + i % 3, i * 0.4) for i in range(300)]),
    }
    backfill(lake, feeds, run, **bounds)
    return feeds


def test_backfill_equals_the_transforms(spark, lake):
    feeds = load(spark, lake)
    three = [feeds[f] for f in ("orders", "payments", "refunds")]
    keys = ("window_start", "window_end", "metric_name", "metric_value")
    assert values(lake.read(KPIS), *keys) == values(commerce_kpis(*three, "UTC"), *keys)
    events = ("event_id", "entity_type", "event_status", "amount", "event_time")
    assert values(lake.read("silver.order_events"), *events) == values(
        order_events(*three, "UTC"), *events)
    bars = ("window_start", "symbol", "exchange", "tick_count", "min_price", "max_price",
            "traded_volume", "buy_tick_count")
    assert values(lake.read("silver.crypto_ticks_1s"), *bars) == values(
        tick_bars(feeds["ticks"], "UTC"), *bars)
    got = {tuple(r)[:2]: tuple(r)[2] for r in lake.read("gold.crypto_market_kpis_1m").select(
        "window_start", "metric_name", "metric_value").collect()}
    want = {tuple(r)[:2]: tuple(r)[2] for r in market_kpis(feeds["ticks"], "UTC").select(
        "window_start", "metric_name", "metric_value").collect()}
    assert got == pytest.approx(want)


def test_backfill_repeats_without_duplicates_and_takes_a_range(spark, lake):
    load(spark, lake)
    load(spark, lake)
    assert lake.read("bronze.orders_cdc").count() == 3
    load(spark, lake, "b", start=datetime(2026, 3, 13, 3, 1), end=datetime(2026, 3, 13, 3, 2))
    assert lake.read("bronze.orders_cdc").count() == 5
    assert lake.read("bronze.refunds_cdc").count() == 1


def test_tables_are_created_once_and_queried_by_name(spark, lake):
    prefix = "t1_"
    catalog.create_tables(lake, prefix)
    load(spark, lake)
    catalog.create_tables(lake, prefix)
    assert {r["namespace"] for r in catalog.layers(spark, prefix).collect()} == {
        "t1_bronze", "t1_silver", "t1_gold"}
    shown = {layer: sorted(r["tableName"] for r in catalog.tables(spark, layer, prefix).collect())
             for layer in schemas.LAYERS}
    assert shown == {
        "bronze": ["crypto_ticks", "orders_cdc", "payments_cdc", "refunds_cdc",
                   "user_behavior_events"],
        "silver": ["crypto_ticks_1s", "order_events", "user_behavior"],
        "gold": ["behavior_kpis_1m", "commerce_kpis_1m", "crypto_market_kpis_1m"],
    }
    orders = spark.sql("SELECT * FROM t1_bronze.orders_cdc ORDER BY cdc_source_ts DESC LIMIT 20")
    assert orders.schema.names == schemas.table_schema("bronze.orders_cdc").names
    assert orders.count() == 3
    assert latest(spark.table("t1_gold.behavior_kpis_1m"), "gold.behavior_kpis_1m").count() == 0


def test_views_show_commits_by_themselves(spark, lake):
    prefix = "t2_"
    catalog.create_tables(lake, prefix)
    for i in range(2):
        lake.append(kpi_rows(spark, (i, "orders_created", i)), KPIS, "orders", i,
                    F.lit(f"2026-01-0{1 + i} 00:00:00 UTC"))
        for session in (spark, spark.newSession()):
            assert session.sql("SELECT * FROM t2_gold.commerce_kpis_1m").count() == i + 1
    broken = f"{lake._leaf(lake.data_path(KPIS), 'orders', 2)}/{DAY}"
    kpi_rows(spark, (5, "orders_created", 99)).write.parquet(broken)
    assert spark.table("t2_gold.commerce_kpis_1m").count() == 2
    listed = spark.sql("SELECT batch_id, added_records FROM t2_lake_files.snapshots WHERE "
                       f"table_name = '{KPIS}' ORDER BY committed_at DESC")
    assert [tuple(r) for r in listed.collect()] == [(1, 1), (0, 1)]
    catalog.pin(lake, "t2_old_", datetime(2026, 1, 1, 12), prefix)
    assert spark.table("t2_old_gold.commerce_kpis_1m").count() == 1
    assert spark.table("t2_gold.commerce_kpis_1m").count() == 2
    for name in (prefix, "t2_old_"):
        catalog.drop(spark, name)
    assert catalog.layers(spark, prefix).count() == 0


def test_any_number_of_writers_reads_in_full(spark, lake, monkeypatch):
    """As many backfills leave them: more writers than a filter should name."""
    monkeypatch.setattr("tidemark.plans.lake.LITERAL_WRITERS", 50)
    count = 120
    rows = spark.range(count).select(
        F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz").alias("window_start"),
        F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz").alias("window_end"),
        F.lit("orders_created").alias("metric_name"), F.col("id").cast("double").alias("metric_value"),
        F.lit(None).cast("timestamp_ntz").alias("produced_at"),
        F.concat(F.lit("backfill-"), "id").alias("writer"), F.lit(0).alias("batch_id"))
    sliced(rows, KPIS, 1).repartition(4).write.partitionBy(
        "writer", "batch_id", "first_day", "last_day").parquet(lake.data_path(KPIS))
    log = rows.select(
        F.concat("writer", F.lit("-0")).alias("snapshot_id"),
        F.timestamp_seconds("metric_value").alias("committed_at"),
        F.lit("append").alias("operation"), F.lit(1).cast("bigint").alias("added_records"),
        "writer", "batch_id")
    log.where("writer <> 'backfill-7'").repartition(4).write.partitionBy(
        "writer", "batch_id").parquet(lake.log_path(KPIS))
    assert lake.read(KPIS).count() == count - 1
    assert lake.read(KPIS, datetime(1970, 1, 1, 0, 0, 9)).count() == 9
    catalog.create_tables(lake, "t3_")
    assert spark.table("t3_gold.commerce_kpis_1m").count() == count - 1
    catalog.drop(spark, "t3_")


def test_a_batch_that_commits_during_a_read_is_left_out_whole(spark, lake, monkeypatch):
    lake.append(kpi_rows(spark, (0, "orders_created", 1)), KPIS, "orders", 0)
    path = Lake.data_path

    def committing(self, table):
        monkeypatch.setattr(Lake, "data_path", path)
        self.append(kpi_rows(spark, (1, "orders_created", 2)), KPIS, "orders", 1)
        return path(self, table)

    monkeypatch.setattr(Lake, "data_path", committing)
    assert lake.read(KPIS).count() == 1
    assert lake.read(KPIS).count() == 2


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Seoul"])
def test_naive_times_are_in_the_lake_s_zone(spark, tmp_path, monkeypatch, zone):
    """Whatever zone the driver's machine is in."""
    monkeypatch.setenv("TZ", "America/Los_Angeles")
    time.tzset()
    try:
        lake = Lake(spark, str(tmp_path / "l"), zone)
        lake.append(kpi_rows(spark, (0, "orders_created", 1)), KPIS, "orders", 0,
                    F.lit(f"2026-03-13 12:00:00 {zone}"))
        assert lake.read(KPIS, datetime(2026, 3, 13, 11, 59)).count() == 0
        assert lake.read(KPIS, datetime(2026, 3, 13, 12, 0)).count() == 1
    finally:
        monkeypatch.undo()
        time.tzset()


def test_a_run_s_name_stands_for_one_range(spark, lake):
    load(spark, lake, "c", end=datetime(2026, 3, 13, 3, 1))
    with pytest.raises(ValueError, match="another range"):
        load(spark, lake, "c", start=datetime(2026, 3, 13, 3, 1))
    load(spark, lake, "cd", start=datetime(2026, 3, 13, 3, 1))
    assert lake.read("bronze.orders_cdc").count() == 3


def test_ranges_cut_anywhere_add_up(spark, lake, tmp_path):
    whole = Lake(spark, str(tmp_path / "whole"), "UTC")
    load(spark, whole)
    cuts = [None, datetime(2026, 3, 13, 3, 0, 20, 300000), datetime(2026, 3, 13, 3, 1),
            datetime(2026, 3, 13, 3, 1, 1), None]
    for i, (start, end) in enumerate(zip(cuts, cuts[1:])):
        load(spark, lake, f"r{i}", start=start, end=end)
    for table in ("bronze.crypto_ticks", "silver.crypto_ticks_1s", "gold.crypto_market_kpis_1m",
                  "silver.order_events", KPIS):
        kept = [c for c in schemas.table_schema(table).names
                if c not in ("produced_at", "ingest_time")]
        got, want = (values(x.read(table), *kept) for x in (lake, whole))
        assert [r[:2] for r in got] == [r[:2] for r in want]
        numbers = [[v for r in rows for v in r if isinstance(v, float)] for rows in (got, want)]
        assert numbers[0] == pytest.approx(numbers[1])


def test_bronze_ticks_round_trip(spark, lake):
    rows = bronze_ticks(feed(spark, "ticks", [tick(1, 2, 3, 4)]), "UTC")
    lake.append(rows, "bronze.crypto_ticks", "ticks", 0)
    assert lake.read("bronze.crypto_ticks").drop("ingest_time").collect() == rows.drop(
        "ingest_time").collect()


# -- slices of days ----------------------------------------------------------

DAY_0 = datetime(2023, 6, 1)


def daily(spark, days, *extra):
    """A KPI row per day, and any others."""
    rows = [(DAY_0 + timedelta(days=i), f"m{i % 3}", float(i)) for i in days] + list(extra)
    return spark.createDataFrame(
        [(w, w, name, v, None) for w, name, v in rows], schemas.table_schema(KPIS))


def scans(df):
    """Partition filters of a plan's scan, and the number of files it opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    filters = plan.toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    return filters, scan.metrics().apply("numFiles").value()


def newest_rows(lake, count, *args):
    return [tuple(r) for r in latest(lake.newest(KPIS, count, *args), KPIS, count).select(
        "window_start", "metric_name", "metric_value").collect()]


def test_newest_rows_of_a_thousand_days_read_one_or_two(spark, lake):
    lake.append(daily(spark, range(1000)), KPIS, "load", 0, spread=True)
    df = lake.newest(KPIS, 2)
    filters, files = scans(df)
    assert files == 2 and "last_day" in filters
    assert newest_rows(lake, 2) == [
        (DAY_0 + timedelta(days=i), f"m{i % 3}", float(i)) for i in (999, 998)]


@pytest.mark.parametrize("days", [1, 30])
def test_newest_rows_are_those_of_a_whole_read(spark, tmp_path, days):
    """Batches in any order of time, late rows, ties on a day's border, and no time at all."""
    lake = Lake(spark, str(tmp_path / "l"), "UTC", slice_days=days)
    border = DAY_0 + timedelta(days=40)
    parts = [
        daily(spark, range(0, 41)), daily(spark, range(20, 30)), daily(spark, [], (None, "none", 1.0)),
        daily(spark, [], *[(border, f"t{i}", 0.0) for i in range(5)],
              *[(border - timedelta(milliseconds=1), f"u{i}", 0.0) for i in range(5)]),
    ]
    for i, part in enumerate(parts):
        lake.append(part, KPIS, "w", i, F.lit(f"2026-01-0{1 + i} 00:00:00 UTC"))
    for at in (None, "2026-01-02 12:00:00 UTC"):
        for count in (6, 12, 100):
            whole = [tuple(r) for r in latest(lake.read(KPIS, at), KPIS, count).select(
                "window_start", "metric_name", "metric_value").collect()]
            assert newest_rows(lake, count, at) == whole
    assert newest_rows(lake, 100)[-1][0] is None


def test_newest_of_nothing(lake, spark):
    assert lake.newest(KPIS, 5).count() == 0
    lake.append(daily(spark, [], (None, "none", 1.0)), KPIS, "w", 0)
    assert lake.newest(KPIS, 5).count() == 1


def test_reads_from_a_time_on_open_no_older_day(spark, lake, monkeypatch):
    for i in range(4):
        lake.append(daily(spark, range(10 * i, 10 * i + 10)), KPIS, "w", i)
    since = DAY_0 + timedelta(days=35)
    df = lake.read(KPIS, since=since)
    filters, files = scans(df)
    assert files == 5 and "last_day" in filters
    want = [(float(i),) for i in range(35, 40)]
    assert values(df, "metric_value") == want
    assert lake.read(KPIS, since=since + timedelta(seconds=1)).count() == 4
    monkeypatch.setattr("tidemark.plans.lake.LITERAL_BATCHES", 0)
    assert values(lake.read(KPIS, since=since), "metric_value") == want


def test_slices_of_different_lengths_lie_side_by_side(spark, lake, tmp_path):
    lake.append(daily(spark, range(20)), KPIS, "w", 0)
    longer = Lake(spark, lake.root, "UTC", slice_days=365)
    longer.append(daily(spark, range(20, 40)), KPIS, "w", 1)
    for reader in (lake, longer):
        assert [r[2] for r in newest_rows(reader, 3)] == [39.0, 38.0, 37.0]
        assert reader.read(KPIS, since=DAY_0 + timedelta(days=15)).count() == 25
        assert reader.read(KPIS).count() == 40


# -- commits of several tables -----------------------------------------------

def test_a_commit_of_two_tables_is_seen_whole_or_not_at_all(spark, lake):
    other = "gold.behavior_kpis_1m"

    def write(batch_id, *, crash=False):
        def second():
            if crash:
                raise RuntimeError("driver lost")
            assert lake.read_batch(KPIS, "w", batch_id).count() == 3
            return daily(spark, range(2))
        return lake.commit({KPIS: lambda: daily(spark, range(3)), other: second}, "w", batch_id)

    assert write(0)
    with pytest.raises(RuntimeError, match="driver lost"):
        write(1, crash=True)
    assert {t: df.count() for t, df in lake.read_together((KPIS, other)).items()} == {
        KPIS: 3, other: 2}
    assert write(1) and not write(1)
    assert (lake.read(KPIS).count(), lake.read(other).count()) == (6, 4)
    assert [r["added_records"] for r in lake.snapshots(KPIS).collect()] == [3, 3]
    assert [r["added_records"] for r in lake.snapshots(other).collect()] == [2, 2]
    catalog.create_tables(lake, "t4_")
    assert spark.table("t4_gold.behavior_kpis_1m").count() == 4
    catalog.drop(spark, "t4_")


def test_tables_read_together_are_of_one_state_of_the_log(spark, lake, monkeypatch):
    other, path = "gold.behavior_kpis_1m", Lake.data_path

    def write(batch_id):
        lake.commit({t: lambda: daily(spark, range(1)) for t in (KPIS, other)}, "w", batch_id)

    def committing(self, table):
        monkeypatch.setattr(Lake, "data_path", path)
        write(1)
        return path(self, table)

    write(0)
    monkeypatch.setattr(Lake, "data_path", committing)
    assert [df.count() for df in lake.read_together((KPIS, other)).values()] == [1, 1]
    assert [df.count() for df in lake.read_together((KPIS, other)).values()] == [2, 2]


def test_a_log_from_before_commits_of_several_tables_is_read(spark, lake):
    lake.append(daily(spark, range(3)), KPIS, "w", 0)
    log = lake._leaf(lake.log_path(KPIS), "w", 0)
    rows = spark.read.parquet(log).drop("changes").collect()
    spark.createDataFrame(rows).write.mode("overwrite").parquet(log)
    assert lake.read(KPIS).count() == 3 and lake.newest(KPIS, 2).count() == 3
    assert lake.read(KPIS, since=DAY_0 + timedelta(days=1)).count() == 2
    assert lake.snapshots(KPIS).first()["added_records"] == 3


# -- strays of a backfill ----------------------------------------------------

def test_a_backfill_reports_records_beyond_the_slack(spark, lake):
    rows = [order(i, 5, i) for i in range(10)]
    apart = F.when(F.col("order_id") < 2, -7200).when(F.col("order_id") == 5, 90000).otherwise(3599)
    orders = feed(spark, "orders", rows).withColumn(
        "record_time", F.col("event_time") - F.make_dt_interval(secs=apart))
    with pytest.raises(StraysError, match="3 records of orders"):
        backfill(lake, {"orders": orders}, "a", max_strays=2)
    assert lake.read("bronze.orders_cdc").count() == 0 and lake.read(KPIS).count() == 0
    report = backfill(lake, {"orders": orders, "payments": feed(
        spark, "payments", [payment(1, 5, 0)])}, "a", max_strays=3)
    assert [tuple(r) for r in report.collect()] == [("orders", 10, 2, 1, 1, 90_000_000)]
    assert lake.read("bronze.orders_cdc").count() == 10
    assert backfill(lake, {"orders": orders}, "a").count() == 0  # stored before
    wide = backfill(lake, {"orders": orders}, "b", slack=timedelta(days=2), max_strays=0)
    assert wide.first()["farthest_ms"] is None
    # A range's report covers what was read for it, also outside the range.
    part = backfill(lake, {"orders": orders}, "c", end=datetime(2026, 3, 13, 3, 0, 1))
    assert part.first()["records"] == 10 and lake.read("bronze.orders_cdc").count() == 21


def test_a_repeated_hour_is_kept_apart(spark, tmp_path):
    """01:30 comes twice in New York on 2026-11-01: two minutes, two bars, two sums."""
    lake = Lake(spark, str(tmp_path / "l"), "America/New_York")
    first = int(datetime(2026, 11, 1, 5, 30, tzinfo=timezone.utc).timestamp() * 1000)
    ticks = [(f"t{i}", "BTC-USD", "x", float(i), 1.0, "BUY", f"x{i}", "test", first + ms)
             for i, ms in enumerate([0, 1, 3_600_000, 3_600_001, 3_600_002, 7_200_000])]
    orders = [(i, 7, "CREATED", 5, "KRW", None, ms, ms, "c", ms)
              for i, ms in enumerate([first, first + 3_600_000])]
    feeds = {"ticks": feed(spark, "ticks", ticks), "orders": feed(spark, "orders", [
        (*r[:3], Decimal(5), *r[4:]) for r in orders])}
    backfill(lake, feeds, "a")
    at = datetime(2026, 11, 1, 1, 30)
    counts = lake.read("gold.crypto_market_kpis_1m").where("metric_name = 'tick_count_1m'")
    assert values(counts, "window_start", "metric_value") == [
        (at, 2.0), (at, 3.0), (at + timedelta(hours=1), 1.0)]
    bars = lake.read("silver.crypto_ticks_1s")
    assert sorted(r.tick_count for r in bars.collect()) == [1, 2, 3]
    created = lake.read(KPIS).where("metric_name = 'orders_created'")
    assert values(created, "window_start", "metric_value") == [(at, 1.0), (at, 1.0)]
