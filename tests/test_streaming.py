from __future__ import annotations

import json
import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from rows import feed, ms, order, payment, refund, tick, values

from tidemark import schemas
from tidemark.operators import commerce_kpis, market_kpis, order_events, tick_bars
from tidemark.operators.gold import chained_minutes
from tidemark.plans.lake import Lake
from tidemark.sources import file_feed, open_feed
from tidemark.streaming import accounts, jobs
from tidemark.streaming.accounts import TABLE, BatchLog, account, totals
from tidemark.streaming.watermarks import watermarked

MARKET = "gold.crypto_market_kpis_1m"
BARS = "silver.crypto_ticks_1s"
KPIS = "gold.commerce_kpis_1m"


class Topic:
    """A feed kept as JSON-lines files; each file is one micro-batch."""

    def __init__(self, spark, root, name):
        self.spark, self.name, self.count = spark, name, 0
        self.path = Path(root) / name
        self.path.mkdir(parents=True)

    def add(self, *rows):
        names = schemas.feed_schema(self.name).names
        lines = [r if isinstance(r, str) else json.dumps(dict(zip(names, r)), default=float)
                 for r in rows]
        file = self.path / f"{self.count:05d}.txt"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1
        return self

    def stream(self):
        if self.name == "ticks":
            schema = schemas.feed_schema("ticks")
            rows = file_feed(self.spark, str(self.path), schema, "json", max_files=1)
            return open_feed(rows, "ticks", decoded=True)
        text = schemas.parse("value STRING")
        raw = file_feed(self.spark, str(self.path), text, "text", max_files=1)
        return open_feed(raw, self.name)


@pytest.fixture
def topic(spark, tmp_path):
    return lambda name: Topic(spark, tmp_path / "topics", name)


def run(lake, *topics, only=None):
    jobs.run_available({t.name: t.stream for t in topics}, lake, only)


def test_stream_equals_batch_on_closed_windows(spark, lake, topic):
    rows = [tick(i, 10 + i % 5, 1 + i % 3, i * 0.9, ["BUY", "SELL"][i % 2]) for i in range(200)]
    closing = tick(999, 1, 1, 1000)
    t = topic("ticks").add(*rows[:80]).add(*rows[80:150]).add(*rows[150:]).add(closing)
    run(lake, t)
    batch = feed(spark, "ticks", rows)
    keys = ("window_start", "window_end", "symbol", "metric_name", "metric_value")
    assert values(lake.read(MARKET), *keys) == values(market_kpis(batch, "UTC"), *keys)
    bars = [c for c in schemas.table_schema(BARS).names if c != "produced_at"]
    assert values(lake.read(BARS), *bars) == values(tick_bars(batch, "UTC"), *bars)
    assert lake.read("bronze.crypto_ticks").count() == 201


def test_commerce_streams_equal_batch(spark, lake, topic):
    orders = [order(i, i, i * 20, op="cru"[i % 3]) for i in range(20)]
    payments = [payment(i, i, i * 20, ["SUCCEEDED", "PENDING"][i % 2]) for i in range(20)]
    refunds = [refund(i, None if i % 2 else i, i * 20) for i in range(20)]
    end = 10_000
    o = topic("orders").add(*orders[:9]).add(*orders[9:], "not json", "[]", "null")
    p = topic("payments").add(*payments)
    r = topic("refunds").add(*refunds)
    for t, last in ((o, order(99, 0, end, op="u")), (p, payment(99, 0, end, "PENDING")),
                    (r, refund(99, 0, end))):
        t.add(last)
    run(lake, o, p, r)
    frames = [feed(spark, "orders", orders), feed(spark, "payments", payments),
              feed(spark, "refunds", refunds)]
    keys = ("window_start", "window_end", "metric_name", "metric_value")
    assert values(lake.read(KPIS), *keys) == values(commerce_kpis(*frames, "UTC"), *keys)
    events = ("event_id", "user_id", "entity_type", "event_status", "amount", "event_time")
    closed = lake.read("silver.order_events").where("event_id <> '99'")
    assert values(closed, *events) == values(order_events(*frames, "UTC"), *events)
    counts = [lake.read(f"bronze.{n}_cdc").count() for n in ("orders", "payments", "refunds")]
    assert sum(counts) == lake.read("silver.order_events").count() == 63


def counted(lake):
    rows = lake.read(MARKET).where("metric_name = 'tick_count_1m'")
    return {r["window_start"].minute: r["metric_value"] for r in rows.collect()}


def test_late_rows_count_in_the_closing_batch_and_are_dropped_one_batch_later(lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 30)).add(tick(2, 1, 1, 70))
    t.add(tick(3, 1, 1, 40), tick(4, 1, 1, 71))   # closes minute 0, and still adds to it
    t.add(tick(5, 1, 1, 50), tick(6, 1, 1, 200))  # minute 0 is out: the first row is dropped
    run(lake, t, only=("ticks_kpis_1m", "ticks_rows"))
    assert counted(lake) == {0: 2.0, 1: 2.0}
    assert lake.read("bronze.crypto_ticks").count() == 6  # the raw table keeps the late row


def test_a_row_at_the_delay_is_not_late(lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 64.9)).add(tick(2, 1, 1, 59.9)).add(tick(3, 1, 1, 200))
    run(lake, t, only=("ticks_kpis_1m",))
    assert counted(lake) == {0: 1.0, 1: 1.0}


def test_an_idle_feed_does_not_hold_back_another(lake, topic):
    o = topic("orders").add(order(1, 5, 0)).add(order(2, 5, 100))
    run(lake, o, topic("payments"), topic("refunds"))
    assert values(lake.read(KPIS), "metric_name", "metric_value") == [
        ("gross_order_value", 5.0), ("orders_created", 1.0)]


def test_rows_outside_the_filter_still_move_the_watermark(lake, topic):
    o = topic("orders").add(order(1, 5, 0)).add(order(1, 5, 100, op="u"))
    p = topic("payments").add(payment(1, 5, 0)).add(payment(2, 5, 100, "PENDING"))
    run(lake, o, p, only=("orders_kpis", "payments_kpis"))
    assert {r["metric_name"] for r in lake.read(KPIS).collect()} == {
        "orders_created", "gross_order_value", "payments_succeeded"}


def test_restart_adds_nothing_and_goes_on_with_new_input(lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 0)).add(tick(2, 1, 1, 100))
    run(lake, t)
    before = [lake.read(x).count() for x in ("bronze.crypto_ticks", BARS, MARKET)]
    run(lake, t)
    assert [lake.read(x).count() for x in ("bronze.crypto_ticks", BARS, MARKET)] == before == [2, 1, 5]
    t.add(tick(3, 1, 1, 300))
    run(lake, t)
    assert [lake.read(x).count() for x in ("bronze.crypto_ticks", BARS, MARKET)] == [3, 2, 10]


def test_a_lost_checkpoint_is_noticed_and_a_generation_starts_over(spark, lake, topic, monkeypatch):
    t = topic("orders").add(order(1, 5, 0))
    run(lake, t, only=("orders_rows",))
    kept = Lake.checkpoint_path
    monkeypatch.setattr(Lake, "checkpoint_path", lambda self, q: kept(self, q) + "-gone")
    with pytest.raises(ValueError, match="new generation"):
        run(lake, t, only=("orders_rows",))
    t.add(order(2, 5, 1))
    for _ in range(2):
        jobs.run_available({"orders": t.stream}, lake, ("orders_rows",), generation="b")
    assert lake.read("bronze.orders_cdc").count() == 1 + 2  # the replay reads all of it again
    assert lake.read("silver.order_events").count() == 3


def test_each_feed_is_decoded_once_per_job(lake, topic):
    """The event table is derived from stored rows, not from the messages."""
    t = topic("orders").add(order(1, 5, 0), order(2, 6, 1))
    reads = []

    def counted_stream():
        reads.append(1)
        return t.stream()

    jobs.run_available({"orders": counted_stream}, lake, ("orders_rows",))
    assert len(reads) == 1 and lake.read("silver.order_events").count() == 2


def test_a_repeated_batch_id_lands_once_in_every_sink(spark, lake):
    job = next(j for j in jobs.JOBS if j.name == "orders_rows")
    write = jobs._write_rows(job, lake, job.name)
    batch = feed(spark, "orders", [order(1, 5, 0)])
    # The first attempt broke off between the two sinks.
    lake.append(job.sinks[0].transform(batch, lake.zone), job.sinks[0].table, job.name, 7)
    for _ in range(2):
        write(batch, 7)
    assert lake.read("bronze.orders_cdc").count() == 1
    assert lake.read("silver.order_events").count() == 1


@pytest.mark.parametrize("job", ["ticks_rows", "ticks_kpis_1m"])
def test_a_crash_between_data_and_commit_leaves_no_gap_and_no_duplicate(
        spark, lake, topic, monkeypatch, job):
    t = topic("ticks").add(*[tick(i, 1, 1, i) for i in range(50)]).add(tick(99, 1, 1, 500))
    table = {"ticks_rows": "bronze.crypto_ticks", "ticks_kpis_1m": MARKET}[job]
    path, crashes = Lake.log_path, []

    def crashing(self, name):
        # The data is written, its row count is known, and the log is about to follow.
        if name == table and len(crashes) < 1 and os.path.exists(self.data_path(name)):
            leaves = list(Path(self.data_path(name)).rglob("_SUCCESS"))
            if leaves:
                crashes.append(leaves)
                raise RuntimeError("driver lost")
        return path(self, name)

    monkeypatch.setattr(Lake, "log_path", crashing)
    with pytest.raises(StreamingQueryException, match="driver lost"):
        run(lake, t, only=(job,))
    monkeypatch.setattr(Lake, "log_path", path)
    assert crashes
    run(lake, t, only=(job,))
    if job == "ticks_rows":
        assert lake.read(table).count() == lake.read(table).distinct().count() == 51
    else:
        assert counted(lake) == {0: 50.0}


def test_state_is_kept_on_disk(spark, lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 0)).add(tick(2, 1, 1, 100))
    run(lake, t, only=("ticks_kpis_1m",))
    state = Path(lake.checkpoint_path("ticks_kpis_1m")) / "state"
    assert list(state.rglob("*.changelog"))


def test_closed_windows_are_written_in_files_sized_by_bytes(lake, topic):
    rows = [tick(i, 1, 1, i, symbol=f"S{i}") for i in range(40)]
    run(lake, topic("ticks").add(*rows).add(tick(99, 1, 1, 500)), only=("ticks_bars_1s",))
    df = lake.read(BARS)
    leaves = {str(Path(f).parent) for f in df.inputFiles()}
    data = [f for leaf in leaves for f in Path(leaf.removeprefix("file:")).glob("*.parquet")]
    assert df.count() == 40 and len(data) == len(leaves)


def test_a_failing_query_raises_and_stops_the_rest(spark, lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 0))

    def failing():
        return t.stream().withColumn("price", F.raise_error(F.lit("boom")).cast("double"))

    with pytest.raises(StreamingQueryException, match="boom"):
        jobs.run_available({"ticks": failing}, lake)
    assert spark.streams.active == []


def test_live_queries_run_side_by_side_and_fail_together(spark, lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 0)).add(tick(2, 1, 1, 100))
    queries = jobs.start_all({"ticks": t.stream}, lake, {"processingTime": "0 seconds"})
    assert {q.name for q in queries} == {"ticks_rows", "ticks_bars_1s", "ticks_kpis_1m"}
    for query in queries:
        query.processAllAvailable()
    assert lake.read(MARKET).count() == 5
    for query in queries[1:]:
        query.stop()
    t.add(tick(3, 1, 1, 200))
    source = t.stream().withColumn("price", F.raise_error(F.lit("boom")).cast("double"))
    failing = jobs.start(jobs.JOBS[7], source, lake, {"processingTime": "0 seconds"})
    with pytest.raises(StreamingQueryException, match="boom"):
        jobs.await_all([queries[0], failing], poll_seconds=1)
    assert spark.streams.active == []


def test_every_fed_table_has_one_writer_per_feed():
    written = [(job.feed, sink.table) for job in jobs.JOBS for sink in job.sinks]
    assert len(written) == len(set(written))
    assert {t for _, t in written} == set(schemas.TABLE_DDL) - {"gold.behavior_kpis_1m"}
    assert len({job.name for job in jobs.JOBS}) == len(jobs.JOBS)
    assert all(len(job.sinks) == 1 for job in jobs.JOBS if job.windowed)


def test_watermark_delays(spark, topic):
    for name, delay in (("orders", "5 seconds"), ("ticks", "5 seconds")):
        plan = watermarked(topic(name).stream(), name)._jdf.queryExecution().analyzed().toString()
        assert f"{delay}" in plan
    assert schemas.WATERMARKS["behavior"] == "10 seconds"


def test_live_trigger_commits_every_thirty_seconds():
    assert jobs.LIVE_TRIGGER == {"processingTime": "30 seconds"}


def test_event_time_of_ms_inputs(spark, lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 0.25))
    run(lake, t, only=("ticks_rows",))
    stored = lake.read("bronze.crypto_ticks").first()["event_time"]
    assert stored.microsecond == 250000 and ms(0.25) % 1000 == 250


def test_chained_windows_read_ticks_once_and_equal_separate_ones(spark, lake, topic, tmp_path):
    rows = [tick(i, 10 + i % 7, 1 + i % 3, i * 0.7, side=("BUY", "SELL", "X")[i % 3],
                 symbol=f"S{i % 2}", exchange=f"E{i % 3}") for i in range(400)]
    t = topic("ticks").add(*rows[:150]).add(*rows[150:]).add(tick(999, 1, 1, 1000))
    separate = Lake(spark, str(tmp_path / "separate"), "UTC")
    run(separate, t, only=("ticks_bars_1s", "ticks_kpis_1m"))
    jobs.run_available({"ticks": t.stream}, lake, ("ticks_chained",), chained=True)
    keys = [c for c in schemas.table_schema(BARS).names if c != "produced_at"]
    got = values(lake.read(BARS), *keys)
    last = max(r[0] for r in lake.read(MARKET).select("window_end").collect())
    want = values(separate.read(BARS).where(F.col("window_start") < F.lit(last)), *keys)
    assert [r[:5] for r in got] == [r[:5] for r in want] and len(got) > 300
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:])
    names = ("window_start", "window_end", "symbol", "metric_name", "metric_value")
    assert values(lake.read(MARKET), *names[:4]) == values(separate.read(MARKET), *names[:4])
    assert [r[0] for r in values(lake.read(MARKET), "metric_value")] == pytest.approx(
        [r[0] for r in values(separate.read(MARKET), "metric_value")])
    # One source in the plan, and each minute's bars and metrics by one commit.
    plan = chained_minutes(watermarked(t.stream(), "ticks"))._jdf.queryExecution()
    assert plan.analyzed().toString().count("StreamingRelation") == 1
    assert [tuple(r)[:2] for r in lake.snapshots(BARS).collect()] == [
        tuple(r)[:2] for r in lake.snapshots(MARKET).collect()]


def test_chained_jobs_fill_the_same_tables():
    def tables(found):
        return sorted(sink.table for job in found for sink in job.sinks)

    assert tables(jobs.CHAINED_JOBS) == tables(jobs.JOBS)


def test_a_crash_between_the_sinks_of_a_job_shows_neither(spark, lake, topic, monkeypatch):
    t = topic("orders").add(*[order(i, 5, i) for i in range(7)])
    written, crashes = Lake._write, []

    def crashing(self, df, table, *args):
        if table == "silver.order_events" and not crashes:
            crashes.append(table)
            raise RuntimeError("driver lost")
        return written(self, df, table, *args)

    monkeypatch.setattr(Lake, "_write", crashing)
    with pytest.raises(StreamingQueryException, match="driver lost"):
        run(lake, t, only=("orders_rows",))
    tables = ("bronze.orders_cdc", "silver.order_events")
    assert [df.count() for df in lake.read_together(tables).values()] == [0, 0]
    run(lake, t, only=("orders_rows",))
    assert [df.count() for df in lake.read_together(tables).values()] == [7, 7]


def test_accounts_tell_dropped_rows_from_open_ones(spark, lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 30)).add(tick(2, 1, 1, 70))
    t.add(tick(3, 1, 1, 40), tick(4, 1, 1, 71))
    # Three late rows of two windows, which Spark's own figure counts as two.
    t.add(tick(5, 1, 1, 50), tick(6, 1, 1, 51), tick(7, 1, 1, 52, symbol="E"), tick(8, 1, 1, 200))
    only = ("ticks_kpis_1m", "ticks_bars_1s")
    jobs.run_available({"ticks": t.stream}, lake, only, counted=True)
    row = account(lake, "ticks_kpis_1m", MARKET).first()
    assert (row["rows"], row["closed_rows"], row["open_rows"], row["dropped_rows"]) == (8, 4, 1, 3)
    assert row["dropped_groups"] == 2
    t.add(tick(9, 1, 1, 53), tick(10, 1, 1, 400))  # goes on in the next run
    jobs.run_available({"ticks": t.stream}, lake, only, counted=True)
    # Both jobs closed the windows of ticks 1 to 4 and 8, and have that of tick 10 open.
    for job, table in (("ticks_kpis_1m", MARKET), ("ticks_bars_1s", BARS)):
        row = account(lake, job, table).first()
        got = (row["rows"], row["closed_rows"], row["open_rows"], row["dropped_rows"])
        assert got == (10, 5, 1, 4), job


def test_rejects_are_counted_per_job(spark, lake, topic):
    o = topic("orders").add(order(1, 5, 0), "not json", "[]").add("null", order(2, 5, 100), "{}")
    jobs.run_available({"orders": o.stream}, lake, ("orders_rows",), counted=True)
    row = totals(lake).first()
    assert (row["job"], row["records"], row["rows"], row["rejects"]) == ("orders_rows", 6, 3, 3)
    assert (row["batches"], row["missing_batches"]) == (2, 0)


def test_gaps_in_the_accounts_are_shown(spark, lake, topic):
    t = topic("ticks").add(tick(1, 1, 1, 0)).add(tick(2, 1, 1, 100))
    run(lake, t, only=("ticks_kpis_1m",))  # nobody listened
    assert account(lake, "ticks_kpis_1m", MARKET).count() == 0
    t.add(tick(3, 1, 1, 300))
    jobs.run_available({"ticks": t.stream}, lake, ("ticks_kpis_1m",), counted=True)
    assert totals(lake).first()["missing_batches"] > 0
    assert account(lake, "ticks_kpis_1m", MARKET).first()["dropped_rows"] is None


def test_a_batch_that_ran_again_counts_once(spark, lake):
    at = datetime(2026, 3, 13)
    schema = schemas.table_schema(TABLE)

    def entry(run, batch, later, records):
        return ("j", run, batch, at + timedelta(seconds=later), 1, records, records, None, 0, 0)

    lake.append(spark.createDataFrame([entry("a", 0, 0, 5), entry("a", 1, 1, 7)], schema),
                TABLE, "log-a", 0)
    lake.append(spark.createDataFrame([entry("b", 1, 9, 8)], schema), TABLE, "log-b", 0)
    row = totals(lake).first()
    assert (row["batches"], row["records"], row["missing_batches"]) == (2, 13, 0)


def test_the_log_of_batches_is_stored_when_it_is_full(spark, lake, topic, monkeypatch):
    monkeypatch.setattr(accounts, "KEPT_ROWS", 1)
    o = topic("orders").add(order(1, 5, 0)).add(order(2, 5, 100))
    with BatchLog(lake) as log:
        for query in jobs.start_all({"orders": o.stream}, lake, jobs.DRAIN_TRIGGER,
                                    ("orders_rows",), counted=True):
            query.awaitTermination()
    assert not log._rows and totals(lake).first()["batches"] == 2
    assert len(lake.committed(TABLE)) == 1
