"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TASK_ROWS = 100_000
LEAST_TASKS = 8


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Names of the folders that ``stored`` writes meanwhile are added to ``paths``."""
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)


def read_paths(df: DataFrame) -> set[str]:
    """Folders and files that ``df`` reads, as its plan names them."""
    found, leaves = set(), df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            paths = leaf.relation().location().rootPaths().iterator()
            while paths.hasNext():
                found.add(paths.next().toUri().getPath())
    return found


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def row_mark(columns: list[str]) -> Column:
    """A hash of the named columns, of any types and names, that tells rows apart."""
    return F.xxhash64(F.to_json(F.struct(*map(quoted, columns)), {"ignoreNullFields": "false"}))


def quoted(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, rows: int | None = None, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It cuts the lineage there: a lost executor re-runs nothing from before, and results of
    sampled or task-numbered steps can't differ between two reads. ``rows``, a bound on the
    number of narrow rows, keeps the files from being many and tiny.
    """
    path = scratch_dir(df.sparkSession)
    if (collected := _written.get()) is not None:
        collected.append(path)
    if rows is not None:
        df = df.coalesce(max(LEAST_TASKS, -(-rows // TASK_ROWS)))
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def numbered(df: DataFrame, order: Iterable[Column], name: str) -> DataFrame:
    """``df`` with its 0-based place in the sort order ``order`` as column ``name``.

    Rows are dealt out by range and stored, numbered inside each range, and moved by the
    number of rows in the ranges before it. Only one row per range meets in one task.
    """
    order = list(order)
    rows = stored(df.repartitionByRange(*order).select(
        F.struct("*").alias("row"), F.spark_partition_id().alias("part")))
    sizes = rows.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    starts = sizes.select("part", before.alias("start"))
    return (
        rows.join(starts, "part").select("part", "start", "row.*")
        .withColumn(name, F.row_number().over(Window.partitionBy("part").orderBy(*order))
                    - 1 + F.col("start"))
        .drop("part", "start")
    )
