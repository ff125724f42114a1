"""Quality checkpoint over the gold tables of a lake, and its result history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import processing_time
from tidemark.operators.quality import (
    CHECKPOINT,
    COMMERCE_SUITE,
    MARKET_SUITE,
    Suite,
    checkpoint,
    suite_result,
)
from tidemark.plans.lake import Lake

RESULTS = "quality.results"


def moment(lake: Lake, now: Column | None) -> datetime:
    """``now`` as a value: folders of days are chosen when a read is planned."""
    when = processing_time(lake.zone) if now is None else now
    return lake.spark.range(1, numPartitions=1).select(when.alias("now")).first()["now"]


def check(lake: Lake, suite: Suite, now: Column | None = None) -> DataFrame:
    """Result of one suite. Only the batches and days that its first rule admits are read."""
    at = moment(lake, now)
    literal = F.lit(at.isoformat(" ")).cast("timestamp_ntz")
    since = lake.spark.range(1, numPartitions=1).select(
        (literal - F.expr(suite.lookback)).alias("since")).first()["since"]
    return suite_result(lake.read(suite.table, since=since), suite, literal, lake.zone)


def run_checks(lake: Lake, now: Column | None = None,
               suites: tuple[Suite, ...] = (COMMERCE_SUITE, MARKET_SUITE)) -> DataFrame:
    """Results of all suites and the combined row. ``now`` is wall-clock in the lake's zone."""
    at = F.lit(moment(lake, now).isoformat(" ")).cast("timestamp_ntz")
    return checkpoint(*[check(lake, suite, at) for suite in suites])


def record(lake: Lake, run_id: int, now: Column | None = None) -> bool:
    """Run the checks once per ``run_id``, keep the results, and give the combined verdict."""
    results = run_checks(lake, now).withColumn("checked_at", processing_time(lake.zone))
    lake.append(results, RESULTS, "checkpoint", run_id)
    kept = lake.read_batch(RESULTS, "checkpoint", run_id)
    return kept.where(kept.suite == CHECKPOINT).first()["success"]


def history(lake: Lake) -> DataFrame:
    """Results of every run."""
    return lake.read(RESULTS)
