"""Databases and tables of the three layers, for SQL users.

The files of a table belong to ``<prefix>lake_files.<layer>_<table>``; the name SQL reads,
``<layer>.<table>``, is a view that joins them to the highest committed batch of each writer,
so it shows each commit by itself. ``<prefix>lake_files.snapshots`` lists the commits of all
tables. ``pin`` gives the views of an earlier time under another prefix.

Sessions that keep listings of tables show what they listed first. ``build_session`` turns
that off; elsewhere set ``spark.sql.filesourceTableRelationCacheSize`` to 0, or read in a new
session, or call ``refresh``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.plans.lake import ALL_LOGS_SCHEMA, Lake, stored_schema


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def create_tables(lake: Lake, prefix: str = "") -> None:
    """Create the databases, tables and views that do not exist yet; safe to repeat."""
    spark = lake.spark
    # Batches are found by listing folders, so a commit needs no catalog call.
    spark.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    for layer in (*schemas.LAYERS, "lake_files"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")
    for table in schemas.TABLE_DDL:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {prefix}lake_files.{table.replace('.', '_')} "
            f"({_columns(stored_schema(table))}) USING parquet PARTITIONED BY (writer, batch_id, "
            f"first_day, last_day) LOCATION '{lake.data_path(table)}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {prefix}lake_files.snapshots ({_columns(ALL_LOGS_SCHEMA)}) "
        f"USING parquet PARTITIONED BY (table_name, writer, batch_id) "
        f"LOCATION '{lake.root}/_snapshots'")
    views(lake, prefix)


def views(lake: Lake, prefix: str = "", name_prefix: str | None = None,
          as_of: str | datetime | None = None) -> None:
    """Create the layer views; with ``as_of``, over what was committed by that time."""
    until = "" if as_of is None else (
        f"AND committed_at <= timestamp_micros({_micros(lake, as_of)})")
    for table in schemas.TABLE_DDL:
        files = f"{prefix}lake_files.{table.replace('.', '_')}"
        names = ", ".join(f"f.{name}" for name in schemas.table_schema(table).names)
        # The log comes first, so it is listed before the files.
        lake.spark.sql(
            f"CREATE OR REPLACE VIEW {prefix if name_prefix is None else name_prefix}{table} AS "
            f"SELECT {names} FROM (SELECT writer, max(batch_id) AS mark "
            f"FROM {prefix}lake_files.snapshots "
            f"WHERE array_contains(split(table_name, '[+]'), '{table}') {until} "
            f"GROUP BY writer) m JOIN {files} f ON f.writer = m.writer AND f.batch_id <= m.mark")


def _micros(lake: Lake, when: str | datetime) -> int:
    return lake.spark.range(1).select(
        F.unix_micros(lake.instant(when).cast("timestamp"))).first()[0]


def pin(lake: Lake, name_prefix: str, as_of: str | datetime, prefix: str = "") -> None:
    """Views ``<name_prefix><layer>.<table>`` of the tables as of a time."""
    for layer in schemas.LAYERS:
        lake.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name_prefix}{layer}")
    views(lake, prefix, name_prefix, as_of)


def refresh(spark: SparkSession, prefix: str = "") -> None:
    """Forget this session's listings of the tables' files."""
    for table in ("snapshots", *[t.replace(".", "_") for t in schemas.TABLE_DDL]):
        spark.catalog.refreshTable(f"{prefix}lake_files.{table}")


def drop(spark: SparkSession, prefix: str) -> None:
    """Drop the databases of ``prefix``; files stay."""
    for layer in (*schemas.LAYERS, "lake_files"):
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")


def layers(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Databases of the layers."""
    shown = spark.sql(f"SHOW DATABASES LIKE '{prefix}*'")
    return shown.where(F.col("namespace").isin(*[prefix + n for n in schemas.LAYERS]))


def tables(spark: SparkSession, layer: str, prefix: str = "") -> DataFrame:
    """Tables of one layer."""
    return spark.sql(f"SHOW TABLES IN {prefix}{layer}")
