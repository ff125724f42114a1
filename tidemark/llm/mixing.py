"""Mixing sources to target weights.

Tokens are words. Word totals per source give each source's target; its repetition rate is
target / total. A document is emitted floor(rate) times, plus one copy whose coin is a hash
of its id: the same documents come out of every run, on any cluster.

Sources in code point order, null last, weigh 5, 2, 1, 5, 2, 1, ... A target never exceeds
``cap`` times its source; the excess goes to the other sources by weight, until no target
is above. The rounds only touch one row per source.

Defined cases: a null text has no words; a source without words keeps each of its documents
once, as its rate is undefined; rows that repeat a ``doc_id`` share one coin; a null
``doc_id`` has a coin of its own. Other columns pass through ``mixed`` whatever their names.
An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, numbered, stored, text_or_empty

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 17
_BIG = "decimal(38,0)"


def words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("bigint")


def coin(seed: int = SEED) -> Column:
    """A number in [0, 1) from the document's id: 52 bits of a digest."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``."""
    rank = numbered(sizes, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    rows = stored(rank.select(
        "source", "source_size", weight.cast(_BIG).alias("weight"),
        (F.col("source_size") * cap).cast(_BIG).alias("most"), F.lit(False).alias("full")))
    while True:
        # One aggregate row: what is left to share, and among which weight.
        left, share = rows.agg(
            F.sum(F.when(F.col("full"), F.col("source_size") - F.col("most"))
                  .otherwise(F.col("source_size"))).cast(_BIG),
            F.sum(F.when(~F.col("full"), F.col("weight"))).cast(_BIG),
        ).first()
        level = F.lit(left or 0).cast(_BIG), F.lit(share or 1).cast(_BIG)
        above = ~F.col("full") & (F.col("weight") * level[0] > F.col("most") * level[1])
        if rows.where(above).isEmpty():
            break
        rows = stored(rows.withColumn("full", F.col("full") | above))
    fair = (F.col("weight") * level[0]).cast("double") / level[1].cast("double")
    return rows.select("source", "source_size", F.when(
        F.col("full"), F.col("most").cast("double")).otherwise(fair).alias("target"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
           seed: int = SEED) -> DataFrame:
    """``docs`` in a column ``row``, with size, source_size, target and copies."""
    rows = docs.select(F.struct("*").alias("row"), F.col("source"), words().alias("size"),
                       coin(seed).alias("coin"))
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = stored(targets(sizes, weights, cap)).withColumnRenamed("source", "goal_source")
    rate = F.col("target") / F.col("source_size")
    many = F.floor("rate") + (F.col("coin") < F.col("rate") - F.floor("rate")).cast("bigint")
    return (
        rows.join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
        .withColumn("rate", F.when(F.col("source_size") == 0, 1.0).otherwise(rate))
        .select("row", "size", "source_size", "target",
                F.least(many, F.lit(cap)).cast("int").alias("copies"))
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
          seed: int = SEED) -> DataFrame:
    """The mix: each row of ``docs``, all its columns, as many times as it is drawn."""
    drawn = copies(docs, weights, cap, seed).where("copies > 0")
    return drawn.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select(
        "row.*")
