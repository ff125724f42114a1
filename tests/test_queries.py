"""What the driver queries do beside their results."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import feed, tick

from tidemark.operators import bronze_ticks
from tidemark.plans import registry
from tidemark.plans.driver_tables import TABLES, DriverTables
from tidemark.plans.lake import Lake

FIRST = datetime(2026, 1, 1)


@pytest.fixture
def tables(spark, tmp_path):
    """Orders, an item of each, and events over two hundred days; one of each has no time."""
    def when(i):
        return FIRST + timedelta(days=i % 200, minutes=i) if i else None

    rows = {
        "orders": [(i, i % 7, "FPO"[i % 3], 10.0 + i, when(i)) for i in range(1200)],
        "lineitem": [(i, i % 50, i % 9, 1, 2.0, 5.0 + i, "RNA"[i % 3], "FO"[i % 2], when(i))
                     for i in range(1200)],
        "events": [(i, when(i), i % 7, "view", 1.0, '{"k": 1}') for i in range(1200)],
    }
    for name, kept in rows.items():
        spark.createDataFrame(kept, TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    return DriverTables(spark, str(tmp_path))


def test_a_newest_row_query_writes_the_table_that_it_reads_once(tables, monkeypatch):
    monkeypatch.setattr(registry, "_LOADED", {})
    written, append = [], Lake.append
    monkeypatch.setattr(Lake, "append", lambda lake, df, table, *a, **k: (
        written.append(table), append(lake, df, table, *a, **k))[1])
    first = registry.query_latest_commerce_kpis(tables).collect()
    assert written == ["gold.commerce_kpis_1m"] and len(first) == 50
    assert registry.query_latest_commerce_kpis(tables).collect() == first
    assert written == ["gold.commerce_kpis_1m"]
    counts = {r["table_name"]: r["row_count"] for r in registry.query_table_counts(tables).collect()}
    assert sorted(written) == sorted(counts) and len(counts) == 8
    assert counts["silver.order_events"] == 2800


def test_newest_bars_are_stored_without_the_ticks_they_are_made_of(tables, monkeypatch):
    monkeypatch.setattr(registry, "_LOADED", {})
    bars = registry.query_latest_bars(tables)
    lake, = registry._LOADED.values()
    assert {t for t in registry._layers(tables) if lake.committed(t)} == {"silver.crypto_ticks_1s"}
    assert bars.count() == 20


@pytest.fixture
def as_planned(spark):
    """No plan is changed while it runs, no side of a join is small enough to be sent, and no
    task reads several files."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.files.maxPartitionBytes": "16k"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_contents_of_other_days_are_not_sent_to_one_task(tables, as_planned, monkeypatch):
    found, check = [], registry.content_conservation
    monkeypatch.setattr(registry, "content_conservation",
                        lambda a, b: (found.append(b), check(a, b))[1])
    days = registry.query_dq_contents(tables)
    shares = [r["count"] for r in found[1].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == found[0].count() == 2800
    assert max(shares) < 0.5 * sum(shares)
    wrong = days.where("NOT equal").select("load", "entity_type", F.dayofmonth("day")).distinct()
    assert [tuple(r) for r in wrong.collect()] == [("swapped", "order", 7)]


def test_slices_of_a_hashed_write_are_written_by_different_tasks(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "l"), "UTC", files_per_batch=2)
    ticks = [tick(i, 1.0, 1.0, 86_400 * (i % 4)) for i in range(400)]
    lake.append(bronze_ticks(feed(spark, "ticks", ticks), "UTC"), "bronze.crypto_ticks", "w", 0)
    files = list(Path(lake.data_path("bronze.crypto_ticks")).rglob("part-*.parquet"))
    assert len(files) == 2 * 4  # as many a slice as asked for
    assert len({re.match(r"part-(\d+)", f.name)[1] for f in files}) == 4  # shuffle partitions
    rows = lake.read("bronze.crypto_ticks")
    assert rows.count() == 400
    assert rows.select(F.col("event_time").cast("date"), F.input_file_name()).distinct().count() == 8


def test_checking_a_hashed_write_sorts_no_rows(tables, capsys):
    found = registry.query_hashed_writes(tables)
    found.explain()
    assert "SortAggregate" not in capsys.readouterr().out
    assert {r["table_name"]: (r["row_count"], r["one_file_a_key"]) for r in found.collect()} == {
        "bronze.orders_cdc": (1200, True), "bronze.payments_cdc": (1200, True),
        "bronze.refunds_cdc": (400, True), "bronze.crypto_ticks": (1200, True),
        "bronze.user_behavior_events": (1200, True)}
