"""Exact duplicates of whole texts, by skew-safe combining.

1. Each task folds its own equal texts (the partial aggregate of the first grouping).
2. Groups of ``(digest, text, salt)`` merge; the salt comes from the row, so a text that
   makes up a third of all rows meets in ``salts`` groups instead of one.
3. The few winners per salt combine to one per ``(digest, text)``.

The text itself is part of every grouping key, so two texts that share a digest never mix.
Rows then look their group up by digest; digests that turn out to stand for several texts,
if any, are looked up by digest and text.

Defined cases: a null text counts as empty; runs of ASCII white space count as one space;
among rows with equal text and equal ``doc_id`` all are ``kept`` in ``duplicates``, and one
stays in ``deduplicated``; a null ``doc_id`` comes after all others. Other columns never
matter to ``duplicates``, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, quoted, row_mark, stored, text_or_empty

SALTS = 32


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def _salt(salts: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts))


def duplicates(docs: DataFrame, salts: int = SALTS,
               digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``."""
    texts = docs.select("doc_id", normalised().alias("body"))
    keyed = texts.select("doc_id", "body", digest(F.col("body")).alias("digest"))
    merged = (
        keyed.groupBy("digest", "body", _salt(salts, "doc_id").alias("salt"))
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    winners = merged.groupBy("digest", "body").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    groups = stored(winners.select("digest", "keep_id", "group_size"))
    shared = stored(groups.groupBy("digest").count().where("count > 1").select("digest"))

    columns = ("doc_id", "keep_id", "group_size", "digest", "body")
    if shared.isEmpty():
        found = keyed.select("doc_id", "digest", F.lit(None).cast("string").alias("body")).join(
            groups, "digest").select(*columns)
    else:
        plain = keyed.join(shared, "digest", "left_anti").join(groups, "digest")
        mixed = keyed.join(shared, "digest", "left_semi").join(winners, ["digest", "body"])
        found = plain.select(*columns).unionByName(mixed.select(*columns))
    sha = F.col("digest") if digest is sha256 else F.sha2("body", 256)
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), sha.alias("text_sha256"))


def deduplicated(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The row with the smallest ``doc_id`` of each group, with all columns of ``docs``.

    Rows with equal text and ``doc_id`` are told apart by a hash of all their columns, which
    may have any types and names.
    """
    body = normalised()
    rest = [c for c in docs.columns if c != "doc_id"]
    first = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"),
                     row_mark(rest).alias("mark"))
    rows = docs.select(
        first.alias("first"), F.struct(*map(quoted, rest)).alias("rest"),
        sha256(body).alias("digest"), body.alias("body"), _salt(salts, "doc_id").alias("salt"))

    def least(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy("digest", "body", *keys).agg(
            F.min("first").alias("first"), F.min_by("rest", "first").alias("rest"))

    winners = least(least(rows, "salt")).select(F.col("first.doc_id"), "rest.*")
    return winners.select(*map(quoted, docs.columns))
