"""Data-quality suites over KPI tables.

A suite passes when at least ``min_rows`` rows meet all of its rules. Rows that break a
rule are not a failure; ``rejected_rows`` reports them beside the verdict.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import processing_time

CHECKPOINT = "lakehouse_gold_checkpoint"


@dataclass(frozen=True)
class Suite:
    name: str
    table: str
    metrics: tuple[str, ...]
    required: tuple[str, ...]
    min_rows: int = 1
    lookback: str = "INTERVAL 1 DAY"

    def rules(self, now: Column) -> dict[str, Column]:
        """Rule name to predicate. A predicate that is NULL is not met."""
        checks = {"recent": F.col("window_start") >= now - F.expr(self.lookback)}
        checks |= {f"{c}_present": F.col(c).isNotNull() for c in self.required}
        checks["known_metric"] = F.col("metric_name").isin(*self.metrics)
        checks["not_negative"] = F.col("metric_value") >= 0
        return checks


COMMERCE_SUITE = Suite("gold_commerce_kpis_suite", "gold.commerce_kpis_1m",
                       schemas.COMMERCE_METRICS, ("window_start",))
MARKET_SUITE = Suite("gold_crypto_market_kpis_suite", "gold.crypto_market_kpis_1m",
                     schemas.MARKET_METRICS, ("window_start", "symbol"))


def _now(now: Column | None, zone: str) -> Column:
    return processing_time(zone) if now is None else now


def conforming(df: DataFrame, suite: Suite, now: Column | None = None,
               zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """Rows that meet every rule. ``now`` is wall-clock time in the table's zone."""
    rules = suite.rules(_now(now, zone)).values()
    return df.where(reduce(lambda a, b: a & b, rules))


def suite_result(df: DataFrame, suite: Suite, now: Column | None = None,
                 zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """One row: ``(suite, observed_rows, success)``."""
    return conforming(df, suite, now, zone).agg(
        F.count("*").alias("observed_rows")
    ).select(
        F.lit(suite.name).alias("suite"),
        "observed_rows",
        (F.col("observed_rows") >= suite.min_rows).alias("success"),
    )


def checkpoint(*results: DataFrame) -> DataFrame:
    """Suite results and one combined row that passes when all of them do."""
    rows = reduce(lambda a, b: a.unionByName(b), results)
    return rows.rollup("suite").agg(
        F.sum("observed_rows").alias("observed_rows"),
        F.bool_and("success").alias("success"),
    ).select(F.coalesce("suite", F.lit(CHECKPOINT)).alias("suite"), "observed_rows", "success")


def rejected_rows(df: DataFrame, suite: Suite, now: Column | None = None,
                  zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """``(suite, rule, rejected_rows)``: all rules counted in one pass."""
    rules = suite.rules(_now(now, zone))
    counts = df.agg(*[
        F.coalesce(F.sum(F.when(rule, 0).otherwise(1)), F.lit(0)).alias(name)
        for name, rule in rules.items()
    ])
    return counts.select(F.lit(suite.name).alias("suite"), *rules).unpivot(
        ["suite"], list(rules), "rule", "rejected_rows")


def conservation(bronze: list[DataFrame], silver: DataFrame) -> DataFrame:
    """Whether the event table holds as many rows as the change tables together."""
    def tally(df: DataFrame, side: str) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")

    parts = [tally(d, "bronze") for d in bronze] + [tally(silver, "silver")]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.agg(*[
        F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))
        .alias(f"{side}_rows") for side in ("bronze", "silver")
    ]).withColumn("balanced", F.col("bronze_rows") == F.col("silver_rows"))


# Columns of the event table that its rows are compared by; the time of writing is not one.
EVENT_COLUMNS = ("event_id", "user_id", "entity_type", "event_status", "amount", "event_time",
                 "source_system")


def fingerprint(*columns: str) -> Column:
    """Aggregate that tells sets of rows apart, whatever their order, and adds up over parts.

    The sum of 64-bit hashes of rows: a row that is lost, doubled or changed moves it, also
    when the number of rows stays the same. Two sets agree by chance with probability 2^-64.
    """
    # A NULL would leave the hash as it was, so which columns are NULL is hashed as well.
    present = [F.col(c).isNotNull() for c in columns]
    return F.sum(F.xxhash64(*columns, *present).cast("decimal(20,0)"))


def content_conservation(expected: DataFrame, found: DataFrame,
                         columns: tuple[str, ...] = EVENT_COLUMNS,
                         group: str = "entity_type", time: str = "event_time") -> DataFrame:
    """``(group, day, expected_rows, found_rows, equal)``: whether both sides hold the same rows.

    One pass over both sides; each task sends a row per group and day. Rows without a time
    form a group of their own, and a side without rows of a group counts 0.
    """
    def side(df: DataFrame, expects: bool) -> DataFrame:
        return df.select(*columns, F.lit(expects).alias("expects"))

    rows = side(expected, True).unionByName(side(found, False))
    day = F.col(time).cast("date").alias("day")
    tallies = rows.groupBy(group, day, "expects").agg(
        F.count("*").alias("n"), fingerprint(*columns).alias("mark"))
    expects = F.col("expects")
    sides = tallies.groupBy(group, "day").agg(
        F.coalesce(F.sum(F.when(expects, F.col("n"))), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum(F.when(~expects, F.col("n"))), F.lit(0)).alias("found_rows"),
        F.max(F.when(expects, F.col("mark"))).alias("expected_mark"),
        F.max(F.when(~expects, F.col("mark"))).alias("found_mark"))
    return sides.select(
        group, "day", "expected_rows", "found_rows",
        ((F.col("expected_rows") == F.col("found_rows"))
         & F.col("expected_mark").eqNullSafe(F.col("found_mark"))).alias("equal"))
