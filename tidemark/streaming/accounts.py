"""Accounts of streaming jobs: what each micro-batch took, left out and dropped.

``BatchLog`` listens to the queries of a session and stores a row per micro-batch in the table
``ops.job_batches`` of the lake: records read, rows decoded from them, the watermark, and how
many window groups it dropped as too late. Spark counts dropped groups after each task has
combined its rows, so that number is a lower bound of dropped rows. ``account`` gives the exact
one for jobs whose windows count their rows: rows taken, less rows in closed windows, less rows
in windows that are still open, which it reads from the job's state as of the same batch.
"""

from __future__ import annotations

import threading
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidemark import schemas
from tidemark.plans.lake import Lake

TABLE = "ops.job_batches"
DECODED = "decoded"    # name of the observation of rows behind the decoder
KEPT_ROWS = 10_000     # rows held in memory before they are stored

# Jobs whose closed windows tell how many rows they hold, and how to add those up. The count of
# rows is the first of their aggregates.
TALLIES = {
    "ticks_bars_1s": "sum(tick_count)",
    "ticks_kpis_1m": "sum(CAST(metric_value AS BIGINT)) FILTER "
                     "(WHERE metric_name = 'tick_count_1m')",
}


def observed(source: DataFrame) -> DataFrame:
    """``source``, an opened feed, with its rows counted per micro-batch."""
    return source.observe(DECODED, F.count(F.lit(1)).alias("rows"))


def _time(text: str | None) -> datetime | None:
    if text is None:
        return None
    return datetime.fromisoformat(text).astimezone(timezone.utc).replace(tzinfo=None)


class BatchLog(StreamingQueryListener):
    """Stores the progress of a session's queries. Times are in UTC.

    Use it as a context: it listens until the block ends, and what it has is stored then, or
    by ``flush``, or when ``KEPT_ROWS`` have come. A lost driver loses what is not stored yet;
    ``account`` shows such gaps as missing batches instead of guessing.
    """

    def __init__(self, lake: Lake):
        self.lake = lake
        self.writer = f"batch-log-{uuid.uuid4().hex[:12]}"
        self._rows: list[tuple] = []
        self._stored = 0
        self._open: set[str] = set()
        self._change = threading.Condition()
        self._writing = threading.Lock()

    # -- events, which come one after another on a thread of their own ------

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        decoded = p.observedMetrics.get(DECODED)
        rows = None if decoded is None else decoded["rows"]
        row = (p.name, str(p.runId), p.batchId, _time(p.timestamp), p.batchDuration,
               p.numInputRows, rows, _time(p.eventTime.get("watermark")),
               sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               sum(s.numRowsTotal for s in p.stateOperators))
        with self._change:
            self._rows.append(row)
            full = len(self._rows) >= KEPT_ROWS
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._open.discard(str(event.runId))
            self._change.notify_all()

    # -- storing -------------------------------------------------------------

    def flush(self) -> None:
        """Store what has come so far."""
        with self._writing:
            with self._change:
                rows = list(self._rows)
            if not rows:
                return
            df = self.lake.spark.createDataFrame(rows, schemas.table_schema(TABLE)).coalesce(1)
            self.lake.append(df, TABLE, self.writer, self._stored)
            self._stored += 1
            with self._change:
                del self._rows[:len(rows)]

    def settle(self, run_ids: set[str], seconds: float = 60) -> bool:
        """Wait for the last events of ended queries; False if they don't come in time."""
        with self._change:
            return self._change.wait_for(lambda: not self._open & run_ids, seconds)

    def __enter__(self) -> BatchLog:
        self.lake.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        active = {str(query.runId) for query in self.lake.spark.streams.active}
        with self._change:
            ended = self._open - active
        self.settle(ended)
        self.lake.spark.streams.removeListener(self)
        self.flush()


def batches(lake: Lake) -> DataFrame:
    """One row per job and batch. A batch that ran again after a restart counts once, as the
    run that started last saw it."""
    order = Window.partitionBy("job", "batch").orderBy(
        F.desc("started_at"), F.desc("records"), "run_id")
    return lake.read(TABLE).withColumn("turn", F.row_number().over(order)).where(
        "turn = 1").drop("turn")


def totals(lake: Lake) -> DataFrame:
    """Per job: batches, records read, those that were no rows (``rejects``), dropped groups.

    ``missing_batches`` are those below the last one that were never stored; with any of them
    the other numbers are too small. ``rejects`` is NULL for jobs that are not observed.
    """
    return batches(lake).groupBy("job").agg(
        F.count("*").alias("batches"),
        (F.max("batch") + 1 - F.count("*")).alias("missing_batches"),
        F.max("batch").alias("last_batch"),
        F.sum("records").alias("records"),
        F.sum("rows").alias("rows"),
        F.sum(F.col("records") - F.col("rows")).alias("rejects"),
        F.sum("dropped_groups").alias("dropped_groups"),
        F.max("watermark").alias("watermark"))


def account(lake: Lake, job: str, table: str, generation: str = "") -> DataFrame:
    """One row for a job of ``TALLIES``: ``rows`` it took are in closed windows, in open ones,
    or dropped. All as of the last batch in the log; none when it has no batch.

    ``dropped_rows`` is NULL when batches are missing or the job was not observed.
    """
    writer = f"{job}-{generation}" if generation else job
    total = totals(lake).where(F.col("job") == writer)
    last = total.select("last_batch").first()
    if last is None:
        return total.select("job", "rows", *[F.lit(None).cast("bigint").alias(c) for c in (
            "closed_rows", "open_rows", "dropped_rows")], "dropped_groups")
    closed = lake.read_writer(table, writer, last[0]).agg(F.expr(TALLIES[job]).alias("n"))
    state = lake.spark.read.format("statestore").option("batchId", last[0]).load(
        lake.checkpoint_path(writer))
    # Buffers of the aggregates in their order, whose names repeat. Rows are counted first.
    buffers = state.schema["value"].dataType.fields
    places = T.StructType([T.StructField(f"buffer{i}", b.dataType) for i, b in enumerate(buffers)])
    held = state.agg(F.sum(F.col("value").cast(places)["buffer0"]).alias("n"))
    closed_rows, open_rows = [F.coalesce(df.scalar(), F.lit(0)) for df in (closed, held)]
    return total.select(
        "job", "rows", closed_rows.alias("closed_rows"), open_rows.alias("open_rows"),
        F.when(F.col("missing_batches") == 0, F.col("rows") - closed_rows - open_rows)
        .alias("dropped_rows"), "dropped_groups")
