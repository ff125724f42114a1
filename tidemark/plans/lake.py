"""Append-only layer tables on shared storage.

A table is a folder of Parquet files, one folder per ``(writer, batch_id)`` with a folder per
slice of days in it, and a snapshot log with one row per committed batch. Each writer owns its
folders, so several feeds append to one table without ever touching the same path.

Appending is idempotent: a batch that is in the log is not written again, and a batch that
is not in the log is invisible, so a lost driver or a repeated micro-batch leaves neither
gaps nor duplicates. One log row may name several tables (``commit``): their rows then become
visible at the same moment, or, after a crash, not at all. A writer's batches commit in order,
hence the committed state at any time is one number per writer: its highest committed batch.
With up to ``LITERAL_WRITERS`` writers, readers turn those numbers into a filter on the
partition columns, which prunes folders at planning time. With more, as many backfills make,
the numbers stay a table that is joined to the partition columns. Either way the log is read
before the data is listed, so a batch that commits meanwhile is left out whole.

A slice is a run of ``slice_days`` days; its folder names its first and its last day, so slices
of different lengths may lie side by side. Reads from a time on (``since``) take the batches
whose days reach that far, as the log has them, and of those the slices that do. ``newest``
reads slices from the last day back until enough rows lie above every slice not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import zoned_instant
from tidemark.operators.layout import conform

LITERAL_WRITERS = 1000
LITERAL_BATCHES = 1000  # batches that a read names one by one

# The time that decides on a row's slice. Newest-row reads sort by it.
TIMES = {
    "bronze.orders_cdc": "cdc_source_ts",
    "bronze.payments_cdc": "cdc_source_ts",
    "bronze.refunds_cdc": "cdc_source_ts",
    "bronze.user_behavior_events": "event_time",
    "bronze.crypto_ticks": "event_time",
    "silver.order_events": "event_time",
    "silver.crypto_ticks_1s": "window_start",
    "silver.user_behavior": "event_time",
    "gold.crypto_market_kpis_1m": "window_start",
    "gold.commerce_kpis_1m": "window_start",
    "gold.behavior_kpis_1m": "window_start",
}

# Columns raw-table writes are hashed on. Together they tell records of one entity apart,
# so an entity, symbol or user with a large share of the rows is still spread over tasks.
HASH_COLUMNS = {
    "bronze.orders_cdc": ("order_id", "updated_at", "cdc_source_ts"),
    "bronze.payments_cdc": ("payment_id", "updated_at", "cdc_source_ts"),
    "bronze.refunds_cdc": ("refund_id", "updated_at", "cdc_source_ts"),
    "bronze.user_behavior_events": ("event_id", "event_time"),
    "bronze.crypto_ticks": ("tick_id", "event_time"),
}
BOOKKEEPING = T.StructType([
    T.StructField("writer", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
DAYS = T.StructType([
    T.StructField("first_day", T.DateType()),
    T.StructField("last_day", T.DateType()),
])
# ``changes`` has the batch's part in each table; ``added_records`` is the sum.
CHANGE = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("added_records", T.LongType()),
    *DAYS.fields,
])
LOG_COLUMNS = T.StructType([
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("added_records", T.LongType()),
    T.StructField("changes", T.ArrayType(CHANGE)),
])
# The tables of a commit, joined by "+", are the log's first folder level.
ALL_LOGS_SCHEMA = T.StructType([T.StructField("table_name", T.StringType()),
                                *LOG_COLUMNS.fields, *BOOKKEEPING.fields])
LISTED = ("snapshot_id", "committed_at", "operation", "added_records", *BOOKKEEPING.names)


def in_zone(when: datetime, zone: str) -> datetime:
    """``when`` as an instant; the machine's own zone has no say in naive times."""
    return when if when.tzinfo is not None else when.replace(tzinfo=ZoneInfo(zone))


def _holds(table: str) -> Column:
    """Whether a log row is of a commit of ``table``; decided on folder names."""
    return F.array_contains(F.split("table_name", "[+]"), table)


def marks_filter(marks: dict[str, int]) -> str:
    """Predicate on the partition columns that keeps committed batches only."""
    terms = [f"(writer = '{w}' AND batch_id <= {n})" for w, n in sorted(marks.items())]
    return " OR ".join(terms) if terms else "false"


def stored_schema(table: str) -> T.StructType:
    """Columns of a table's files and of the folders around them."""
    return T.StructType([*schemas.table_schema(table).fields, *BOOKKEEPING.fields,
                         *(DAYS.fields if table in TIMES else ())])


def sliced(df: DataFrame, table: str, days: int) -> DataFrame:
    """Rows with the first and the last day of their slice."""
    if table not in TIMES:
        return df
    epoch = F.lit("1970-01-01").cast("date")
    day = F.datediff(F.col(TIMES[table]).cast("date"), epoch)
    first = F.date_add(epoch, day - F.pmod(day, F.lit(days)))
    return df.withColumns({"first_day": first, "last_day": F.date_add(first, days - 1)})


def distributed(rows: DataFrame, table: str, files: int | None) -> DataFrame:
    """Hash the rows of each slice of a raw table over ``files`` tasks before writing; file layout
    only. Up to ``spark.sql.shuffle.partitions`` tasks write, so that one has few slices to sort.
    """
    columns = HASH_COLUMNS.get(table)
    if files is None or columns is None:
        return rows
    side_by_side = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // files, 1)
    part = F.pmod(F.hash(*columns), F.lit(files))
    number = F.expr("datediff(first_day, DATE '1970-01-01') "
                    "div (datediff(last_day, first_day) + 1)")
    turn = F.pmod(F.coalesce(number, F.lit(0)), F.lit(side_by_side)).cast("int")
    return rows.repartitionById(files * side_by_side, turn * files + part)


@dataclass(frozen=True)
class Lake:
    """Tables under ``root``, with times in ``zone``.

    ``files_per_batch`` spreads each raw batch over that many files a slice. Without it a batch is
    written as it arrives, one file per task and slice, and no shuffle. ``slice_days`` is the
    length of new slices; tables with few rows a day are better off with longer ones.
    """

    spark: SparkSession
    root: str
    zone: str = schemas.LOCAL_ZONE
    files_per_batch: int | None = None
    slice_days: int = 1

    # -- folders ---------------------------------------------------------

    def data_path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def log_path(self, tables: str) -> str:
        return f"{self.root}/_snapshots/table_name={tables}"

    def checkpoint_path(self, query: str) -> str:
        return f"{self.root}/_checkpoints/{query}"

    @staticmethod
    def _leaf(path: str, writer: str, batch_id: int) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_-]+", writer):
            raise ValueError(f"writer name {writer!r} must be letters, digits, '_' or '-'")
        return f"{path}/writer={writer}/batch_id={batch_id}"

    def _open(self, schema: T.StructType, *paths: str, base: str | None = None) -> DataFrame | None:
        """Files under ``paths``, or None when nothing has been written yet."""
        reader = self.spark.read.schema(schema)
        try:
            return (reader if base is None else reader.option("basePath", base)).parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _read(self, schema: T.StructType, *paths: str, base: str | None = None) -> DataFrame:
        """Rows under ``paths``; none when nothing has been written yet."""
        rows = self._open(schema, *paths, base=base) if paths else None
        return self.spark.createDataFrame([], schema) if rows is None else rows

    # -- writing ---------------------------------------------------------

    def is_committed(self, table: str, writer: str, batch_id: int) -> bool:
        base = f"{self.root}/_snapshots"
        entry = self._open(ALL_LOGS_SCHEMA, self._leaf(f"{base}/*", writer, batch_id), base=base)
        return entry is not None and not entry.where(_holds(table)).isEmpty()

    def _write(self, df: DataFrame, table: str, writer: str, batch_id: int,
               spread: bool) -> tuple[str, int, date | None, date | None]:
        """Write one batch of a table; its number of rows and its days. Commits nothing."""
        leaf = self._leaf(self.data_path(table), writer, batch_id)
        rows = distributed(sliced(conform(df, table), table, self.slice_days), table,
                           self.files_per_batch)
        days = DAYS.names if table in TIMES else []
        if spread:
            rows = rows.hint("rebalance", *days)
        rows.write.mode("overwrite").partitionBy(*days).parquet(leaf)
        # Counted from the footers of the files just written, not by running df again.
        schema = T.StructType([*schemas.table_schema(table).fields, *(DAYS.fields if days else ())])
        found = self._read(schema, leaf).agg(F.count("*"), *(
            [F.min("first_day"), F.max("last_day")] if days else [F.lit(None), F.lit(None)])).first()
        return table, *found

    def append(self, df: DataFrame, table: str, writer: str, batch_id: int,
               committed_at: datetime | Column | None = None, spread: bool = False,
               verify: Callable[[], None] | None = None) -> bool:
        """Write ``df`` as one batch of ``writer`` and commit it. Batch ids must grow.

        Gives False, and writes nothing, when that batch has been committed before. A batch
        without rows is not logged; repeating it is harmless. ``spread`` shuffles the rows by
        slice, as a batch of many days needs so that a slice is not cut into a file per task.
        ``verify`` is called between the write and the commit; what it raises prevents that.
        """
        return self.commit({table: lambda: df}, writer, batch_id, committed_at, spread, verify)

    def commit(self, writes: dict[str, Callable[[], DataFrame]], writer: str, batch_id: int,
               committed_at: datetime | Column | None = None, spread: bool = False,
               verify: Callable[[], None] | None = None) -> bool:
        """Write one batch of ``writer`` to several tables, in order, and commit all of it with
        one log row. A later table's rows may be made from what ``read_batch`` gives of an
        earlier one. Gives False when every table has the batch already.
        """
        open_ = {t: w for t, w in writes.items() if not self.is_committed(t, writer, batch_id)}
        parts = [self._write(build(), table, writer, batch_id, spread)
                 for table, build in open_.items()]
        if open_ and verify is not None:
            verify()
        added = sum(count for _, count, _, _ in parts)
        if added:
            when = F.current_timestamp() if committed_at is None else committed_at
            changes = LOG_COLUMNS["changes"].dataType.simpleString()
            entry = self.spark.range(1, numPartitions=1).select(
                F.lit(f"{writer}-{batch_id}").alias("snapshot_id"),
                (when if isinstance(when, Column) else F.lit(when)).cast("timestamp")
                .alias("committed_at"),
                F.lit("append").alias("operation"),
                F.lit(added).cast("bigint").alias("added_records"),
                F.array(*(F.struct(*map(F.lit, part)) for part in parts)).cast(changes)
                .alias("changes"),
            )
            log = self._leaf(self.log_path("+".join(open_)), writer, batch_id)
            entry.write.mode("overwrite").parquet(log)
        return bool(open_)

    # -- reading ---------------------------------------------------------

    def _log(self) -> DataFrame:
        """The commits of all tables, as listed now."""
        return self._read(ALL_LOGS_SCHEMA, f"{self.root}/_snapshots")

    def _entries(self, table: str, as_of: str | datetime | None = None,
                 log: DataFrame | None = None) -> DataFrame:
        """The commits of one table, with what they changed in it."""
        rows = (self._log() if log is None else log).where(_holds(table))
        if as_of is not None:
            rows = rows.where(F.col("committed_at") <= self.instant(as_of).cast("timestamp"))
        alone = F.array(F.struct(  # as logs from before commits of several tables have it
            F.lit(table).alias("table_name"), "added_records",
            F.lit(None).cast("date").alias("first_day"), F.lit(None).cast("date").alias("last_day")))
        change = F.explode(F.coalesce("changes", alone)).alias("change")
        return rows.select("snapshot_id", "committed_at", "operation", *BOOKKEEPING.names, change
                           ).where(F.col("change.table_name") == table).select(
            "snapshot_id", "committed_at", "operation", "change.added_records",
            *BOOKKEEPING.names, "change.first_day", "change.last_day")

    def snapshots(self, table: str) -> DataFrame:
        """Committed batches, newest first."""
        rows = self._entries(table).where("added_records > 0").select(*LISTED)
        return rows.orderBy(F.col("committed_at").desc_nulls_last(), "snapshot_id")

    def instant(self, when: str | datetime) -> Column:
        """An instant from text with a zone, or from a time; naive times are in ``zone``."""
        return zoned_instant(when) if isinstance(when, str) else F.lit(in_zone(when, self.zone))

    def marks(self, table: str, as_of: str | datetime | None = None,
              log: DataFrame | None = None) -> DataFrame:
        """``(writer, mark)``: highest committed batch per writer, now or as of a time."""
        entries = self._entries(table, as_of, log)
        return entries.groupBy("writer").agg(F.max("batch_id").alias("mark"))

    def committed(self, table: str, as_of: str | datetime | None = None) -> dict[str, int]:
        """``marks`` as a dictionary."""
        return {row["writer"]: row["mark"] for row in self.marks(table, as_of).collect()}

    def writers(self, prefix: str) -> DataFrame:
        """Names of writers of any table that begin with ``prefix``."""
        return self._log().where(F.col("writer").startswith(prefix)).select("writer").distinct()

    def read(self, table: str, as_of: str | datetime | None = None,
             since: datetime | None = None) -> DataFrame:
        """Committed rows of ``table``; with ``as_of``, those committed by that time; with
        ``since``, those whose time (see ``TIMES``), a wall-clock time, is not before it.

        ``as_of`` is a time (naive: in the lake's zone) or text with a zone,
        ``2026-03-13 12:00:00 Asia/Seoul``.
        Columns added to the schema later are NULL in older files.
        """
        return self._resolved(table, as_of, self._log(), since)

    def read_together(self, tables: tuple[str, ...],
                      as_of: str | datetime | None = None) -> dict[str, DataFrame]:
        """Committed rows of several tables, all as of the same state of the log."""
        log = self._log()
        return {table: self._resolved(table, as_of, log) for table in tables}

    def _resolved(self, table: str, as_of: str | datetime | None, log: DataFrame,
                  since: datetime | None = None) -> DataFrame:
        if since is not None:
            return self._from(table, as_of, log, since)
        marks = self.marks(table, as_of, log)  # before the data is listed
        known = marks.limit(LITERAL_WRITERS + 1).collect()
        rows = self._read(stored_schema(table), self.data_path(table))
        if len(known) <= LITERAL_WRITERS:
            rows = rows.where(marks_filter({row["writer"]: row["mark"] for row in known}))
        else:
            rows = marks.join(rows, "writer").where(F.col("batch_id") <= F.col("mark"))
        return rows.select(*schemas.table_schema(table).names)

    def _from(self, table: str, as_of: str | datetime | None, log: DataFrame,
              since: datetime) -> DataFrame:
        """Rows from a time on: the batches that reach it, and of those the slices that do."""
        day = F.lit(since.date().isoformat()).cast("date")
        reaching = self._entries(table, as_of, log).where("added_records > 0").where(
            (F.col("last_day") >= day) | F.col("last_day").isNull()).select(*BOOKKEEPING.names)
        rows = self._of_batches(table, reaching)
        when = F.lit(since.isoformat(" ")).cast("timestamp_ntz")
        return rows.where((F.col("last_day") >= day) & (F.col(TIMES[table]) >= when)).select(
            *schemas.table_schema(table).names)

    def _of_batches(self, table: str, batches: DataFrame) -> DataFrame:
        """Rows of ``batches``, committed ones, with the columns of the folders around them."""
        named = batches.limit(LITERAL_BATCHES + 1).collect()
        path, schema = self.data_path(table), stored_schema(table)
        if len(named) <= LITERAL_BATCHES:
            return self._read(schema, *(self._leaf(path, *row) for row in named), base=path)
        return self._read(schema, path).join(batches, BOOKKEEPING.names, "left_semi")

    def unseen(self, table: str, seen: DataFrame) -> DataFrame:
        """Committed rows of the batches that ``seen`` (``writer, batch_id``) doesn't name, with
        their writer and batch."""
        batches = self._entries(table).where("added_records > 0").select(*BOOKKEEPING.names)
        rows = self._of_batches(table, batches.join(seen, BOOKKEEPING.names, "left_anti"))
        return rows.select(*schemas.table_schema(table).names, *BOOKKEEPING.names)

    def newest(self, table: str, count: int, as_of: str | datetime | None = None) -> DataFrame:
        """Committed rows of ``table`` among which its ``count`` newest are, ties included.

        Slices are read from the last day back, twice as far each time, until ``count`` rows
        are not before the first day read: every row not read lies before all of them. If
        there are fewer rows with a time, all rows are given, those without a time too.
        """
        log = self._log()
        last, first = self._entries(table, as_of, log).agg(
            F.max("last_day"), F.min("first_day")).first()
        back = 0
        while last is not None and last - timedelta(days=back) > first:
            since = datetime.combine(last - timedelta(days=back), datetime.min.time())
            rows = self._from(table, as_of, log, since)
            if rows.limit(count).count() >= count:
                return rows
            back = 2 * back + max(self.slice_days, 1)
        return self._resolved(table, as_of, log)

    def read_writer(self, table: str, writer: str, last: int) -> DataFrame:
        """Committed rows of one writer up to batch ``last``."""
        mark = self.committed(table).get(writer, -1)
        rows = self._read(stored_schema(table), self.data_path(table))
        return rows.where(marks_filter({writer: min(mark, last)})).select(
            *schemas.table_schema(table).names)

    def read_batch(self, table: str, writer: str, batch_id: int) -> DataFrame:
        """Rows of one batch."""
        leaf = self._leaf(self.data_path(table), writer, batch_id)
        names = schemas.table_schema(table).names
        return self._read(stored_schema(table), leaf, base=self.data_path(table)).select(*names)
