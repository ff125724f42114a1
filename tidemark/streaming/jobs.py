"""Streaming jobs: each feed's queries and the tables they append to.

Every feed has a query that appends its rows, and feeds with KPIs have one query per
windowed aggregate. No query spans two feeds, so an idle feed never stalls another one's
windows. A query is the only writer of its batches (see ``Lake``), and repeats after a
restart are recognised, so each batch lands once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.bronze import CHANGE_TABLES, bronze_behavior, bronze_changes, bronze_ticks
from tidemark.operators.gold import (
    bars_of_minutes,
    chained_minutes,
    kpis_of_minutes,
    market_kpis,
    order_kpis,
    payment_kpis,
    refund_kpis,
)
from tidemark.operators.silver import entity_events, silver_behavior, tick_bars
from tidemark.plans.backfill import with_event_time
from tidemark.plans.lake import Lake
from tidemark.streaming.accounts import BatchLog, observed
from tidemark.streaming.watermarks import watermarked

LIVE_TRIGGER = {"processingTime": "30 seconds"}
DRAIN_TRIGGER = {"availableNow": True}
ADAPTIVE = "spark.sql.adaptive.enabled"

Transform = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Sink:
    table: str
    transform: Transform


@dataclass(frozen=True)
class Job:
    """One streaming query. ``windowed`` jobs aggregate on the stream: by their only sink's
    transform, or by ``aggregate``, from whose rows each sink then makes its own.

    The first sink of other jobs takes the feed's rows; later ones take the rows it stored.
    """

    feed: str
    name: str
    windowed: bool
    sinks: tuple[Sink, ...]
    aggregate: Callable[[DataFrame], DataFrame] | None = None


def _changes(feed: str) -> Job:
    return Job(feed, f"{feed}_rows", False, (
        Sink(CHANGE_TABLES[feed][0], lambda df, zone: bronze_changes(df, feed, zone)),
        Sink("silver.order_events",
             lambda raw, zone: entity_events(with_event_time(raw, feed), feed, zone)),
    ))


def _windowed(feed: str, name: str, table: str, transform: Transform) -> Job:
    return Job(feed, name, True, (Sink(table, transform),))


JOBS = (
    _changes("orders"),
    _windowed("orders", "orders_kpis", "gold.commerce_kpis_1m", order_kpis),
    _changes("payments"),
    _windowed("payments", "payments_kpis", "gold.commerce_kpis_1m", payment_kpis),
    _changes("refunds"),
    _windowed("refunds", "refunds_kpis", "gold.commerce_kpis_1m", refund_kpis),
    Job("ticks", "ticks_rows", False, (Sink("bronze.crypto_ticks", bronze_ticks),)),
    _windowed("ticks", "ticks_bars_1s", "silver.crypto_ticks_1s", tick_bars),
    _windowed("ticks", "ticks_kpis_1m", "gold.crypto_market_kpis_1m", market_kpis),
    Job("behavior", "behavior_rows", False, (
        Sink("bronze.user_behavior_events", bronze_behavior),
        Sink("silver.user_behavior", lambda raw, zone: silver_behavior(raw)),
    )),
)

# Bars and market metrics by one query, which reads ticks once; bars then wait for the end of
# their minute. Both tables get a minute by one commit.
CHAINED = Job("ticks", "ticks_chained", True, (
    Sink("silver.crypto_ticks_1s", bars_of_minutes),
    Sink("gold.crypto_market_kpis_1m", kpis_of_minutes),
), chained_minutes)
CHAINED_JOBS = (*(job for job in JOBS if job.feed != "ticks" or not job.windowed), CHAINED)


def _write_rows(job: Job, lake: Lake, writer: str) -> Callable[[DataFrame, int], None]:
    """Messages are decoded once, into the first table; nothing is kept in memory. All sinks
    of a micro-batch become visible by one commit."""
    first, *later = job.sinks

    def write(batch: DataFrame, batch_id: int) -> None:
        def derived(sink: Sink) -> DataFrame:
            return sink.transform(lake.read_batch(first.table, writer, batch_id), lake.zone)

        lake.commit({first.table: lambda: first.transform(batch, lake.zone)}
                    | {s.table: lambda s=s: derived(s) for s in later}, writer, batch_id)
    return write


def _write_windows(job: Job, lake: Lake, writer: str) -> Callable[[DataFrame, int], None]:
    """Writer of closed windows, which are few rows spread over every state partition.

    Stateful queries run without adaptive execution. The state of this batch has its plan
    by now, so the write alone may use it: it then sizes files by bytes instead of leaving
    one small file per state partition.
    """
    def rows_of(sink: Sink, batch: DataFrame) -> DataFrame:
        return batch if job.aggregate is None else sink.transform(batch, lake.zone)

    def write(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(ADAPTIVE)
        conf.set(ADAPTIVE, "true")
        several = len(job.sinks) > 1
        if several:  # closed windows only; without this each sink would run the batch anew
            batch.persist()
        try:
            lake.commit({s.table: lambda s=s: rows_of(s, batch) for s in job.sinks}, writer,
                        batch_id, spread=True)
        finally:
            if several:
                batch.unpersist()
            conf.set(ADAPTIVE, before)
    return write


def writer_of(job: Job, generation: str) -> str:
    return f"{job.name}-{generation}" if generation else job.name


def _claim(job: Job, lake: Lake, generation: str, checkpoint: str) -> None:
    """A writer's batch ids go on from its checkpoint. Without one they would begin at 0
    again, and new rows would pass for batches that are already there."""
    try:
        if not lake.spark.read.text(f"{checkpoint}/metadata").isEmpty():
            return
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    writer = writer_of(job, generation)
    if not lake.writers(writer).where(F.col("writer") == writer).isEmpty():
        raise ValueError(
            f"{writer} has committed to {lake.root}, but its checkpoint {checkpoint} is gone; "
            "start a new generation, which reads its feed from the beginning")


def start(job: Job, source: DataFrame, lake: Lake, trigger: dict | None = None,
          delay: str | None = None, generation: str = "",
          counted: bool = False) -> StreamingQuery:
    """Start one job on ``source``, the opened stream of its feed.

    ``counted`` has the rows of each micro-batch counted behind the decoder, for a ``BatchLog``.

    A ``generation`` has its own checkpoint and its own batches: naming a new one is how to
    start over, or to replay input into the same lake.
    """
    writer = writer_of(job, generation)
    checkpoint = lake.checkpoint_path(writer)
    _claim(job, lake, generation, checkpoint)
    if counted:
        source = observed(source)
    if job.windowed:
        late = watermarked(source, job.feed, delay)
        rows = (job.sinks[0].transform(late, lake.zone) if job.aggregate is None
                else job.aggregate(late))
        write = _write_windows(job, lake, writer)
    else:
        rows, write = source, _write_rows(job, lake, writer)
    return (
        rows.writeStream.queryName(writer)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or LIVE_TRIGGER))
        .foreachBatch(write)
        .start()
    )


def start_all(sources: dict[str, Callable[[], DataFrame]], lake: Lake,
              trigger: dict | None = None, only: tuple[str, ...] | None = None,
              generation: str = "", chained: bool = False,
              counted: bool = False) -> list[StreamingQuery]:
    """Start every job whose feed has a source. ``sources`` opens a feed's stream anew.

    ``chained`` computes bars and market metrics by one query (see ``CHAINED``)."""
    return [
        start(job, sources[job.feed](), lake, trigger, generation=generation, counted=counted)
        for job in (CHAINED_JOBS if chained else JOBS)
        if job.feed in sources and (only is None or job.name in only)
    ]


def run_available(sources: dict[str, Callable[[], DataFrame]], lake: Lake,
                  only: tuple[str, ...] | None = None, generation: str = "",
                  chained: bool = False, counted: bool = False) -> None:
    """Process all input present, then stop. A failed query raises here.

    ``counted`` stores the accounts of each micro-batch (see ``BatchLog``)."""
    with BatchLog(lake) if counted else nullcontext():
        queries = start_all(sources, lake, DRAIN_TRIGGER, only, generation, chained, counted)
        try:
            for query in queries:
                query.awaitTermination()
        finally:
            for query in queries:
                query.stop()


def await_all(queries: list[StreamingQuery], poll_seconds: int = 5,
              log: BatchLog | None = None, store_seconds: int = 300) -> None:
    """Wait on live queries; the first one that ends stops the others, and a failure raises.
    Accounts in ``log`` are stored every ``store_seconds``."""
    stored = time.monotonic()
    try:
        while queries and all(query.isActive for query in queries):
            queries[0].awaitTermination(poll_seconds)
            if log is not None and time.monotonic() - stored >= store_seconds:
                log.flush()
                stored = time.monotonic()
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
