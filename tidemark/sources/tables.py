"""Batch reads of tables and query results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_scan(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Table at ``path``. Columns and filters applied later reach the file scan."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_evolved(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files of several schema versions under one declared schema.

    Columns a file lacks are NULL. No footers are merged, so opening a table of many files
    costs no more than opening one.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def union_versions(*versions: DataFrame) -> DataFrame:
    """Rows of several schema versions by column name, NULL where a version lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), versions)


def query_batch(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Result of a SQL query as a dataset; ``frames`` are named in it as ``{name}``."""
    return spark.sql(query, **frames)
