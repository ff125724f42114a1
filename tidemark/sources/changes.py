"""Change-feed preparation: envelopes, the initial snapshot, and table routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import wall_clock_to_epoch_ms
from tidemark.sources.decode import decode_json


def unwrap(df: DataFrame, row: T.StructType, value: str = "value",
           rename: dict[str, str] | None = None) -> DataFrame:
    """Flatten change envelopes to rows.

    Gives the row's columns plus ``__op``, ``__schema``, ``__table``, ``__source_ts_ms`` and
    ``__deleted``. A delete keeps the image before it; messages without a value are left out.
    ``rename`` maps table column names to the names the feeds declare.
    """
    names = rename or {}
    envelopes = decode_json(df, schemas.envelope_schema(row), value)
    image = F.coalesce(F.col("after"), F.col("before"))
    return (
        envelopes.withColumn("image", image)
        .where(F.col("image").isNotNull())
        .select(
            *[F.col(f"image.{c}").alias(names.get(c, c)) for c in row.names],
            F.col("op").alias("__op"),
            F.col("source.schema").alias("__schema"),
            F.col("source.table").alias("__table"),
            F.col("source.ts_ms").alias("__source_ts_ms"),
            F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"),
        )
    )


def snapshot_rows(table: DataFrame, feed: str, source_ts_ms: Column | None = None,
                  zone: str = "UTC") -> DataFrame:
    """Existing table rows as the first entries of a change log, with op ``r``.

    Columns the feed declares as ``<name>_ms`` are taken from the table's ``<name>``.
    """
    known = set(table.columns)
    columns = []
    for field in schemas.feed_schema(feed):
        name = field.name
        if name == "__op":
            value = F.lit("r")
        elif name == "__source_ts_ms":
            value = F.lit(None) if source_ts_ms is None else source_ts_ms
        elif name in known:
            value = F.col(name)
        else:
            stamp = name.removesuffix("_ms")
            ntz = isinstance(table.schema[stamp].dataType, T.TimestampNTZType)
            value = (wall_clock_to_epoch_ms(F.col(stamp), zone) if ntz
                     else F.unix_millis(F.col(stamp)))
        columns.append(value.cast(field.dataType).alias(name))
    return table.select(*columns)


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Initial snapshot rows followed by the live changes."""
    return snapshot.unionByName(changes, allowMissingColumns=True)


def hand_over(snapshot: DataFrame, changes: DataFrame, key: str, position: str,
              begun: Column | None = None, ended: Column | None = None) -> DataFrame:
    """Snapshot rows, then the changes that they do not hold yet.

    ``position`` orders the source's log. A snapshot row has the position at which it was read,
    so that chunks read one after another may differ, and a change its own. Both sides may
    overlap. A change is in the snapshot already, and left out,

    - at or below the position of its key's row, or
    - at or below ``begun``, where the snapshot was opened, whatever its key.

    A key without a row was absent when its chunk was read: what happened to it since ``begun``
    is nowhere else, so its changes stay. The same goes for changes without a position. A row
    without one counts as read at ``begun``; of rows that repeat a key the last position counts.

    ``begun`` and ``ended`` are the first and last positions of the snapshot, by default the
    rows' own. Changes above ``ended`` can't be in it: only those between the two are joined,
    so the shuffle is bounded by the time that the snapshot took, not by the log.
    """
    read = snapshot.select(F.col(key).alias("read_key"), F.col(position).alias("read_at"))
    # Both are NULL without rows: then there is nothing that a change could repeat.
    begun = read.agg(F.min("read_at")).scalar() if begun is None else begun
    ended = read.agg(F.max("read_at")).scalar() if ended is None else ended
    at, last = F.col(position), F.greatest(begun, ended)
    after = changes.where(at.isNull() | (at > last) | last.isNull())
    within = changes.where((at > begun) & (at <= ended))
    newest = read.where("read_key IS NOT NULL").groupBy("read_key").agg(
        F.max("read_at").alias("read_at"))
    unread = within.join(newest, (F.col(key) == F.col("read_key")) & (at <= F.col("read_at")),
                         "left_anti")
    return (snapshot.unionByName(unread, allowMissingColumns=True)
            .unionByName(after, allowMissingColumns=True))


def allow_listed(df: DataFrame, tables: tuple[str, ...] = schemas.CAPTURED_TABLES,
                 prefix: str = schemas.TOPIC_PREFIX) -> DataFrame:
    """Keep changes of the listed ``schema.table`` names and add their ``topic``."""
    source = F.concat_ws(".", "__schema", "__table")
    return df.where(source.isin(*tables)).withColumn(
        "topic", F.concat_ws(".", F.lit(prefix), source))


def route(df: DataFrame, tables: tuple[str, ...] = schemas.CAPTURED_TABLES) -> dict[str, DataFrame]:
    """One filtered branch per listed table."""
    return {name: allow_listed(df, (name,)) for name in tables}
