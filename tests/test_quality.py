from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F
from rows import values

from tidemark import schemas
from tidemark.operators import (
    COMMERCE_SUITE,
    MARKET_SUITE,
    checkpoint,
    conservation,
    content_conservation,
    rejected_rows,
    suite_result,
)
from tidemark.operators.quality import CHECKPOINT, fingerprint
from tidemark.plans.quality import history, record, run_checks

NOW = datetime(2026, 3, 13, 12, 0)
GOOD = (NOW, "orders_created", 1.0)
BAD = [
    (NOW, "orders_created", None),
    (NOW, "unlisted", 1.0),
    (NOW, "refund_amount", -1.0),
    (NOW - timedelta(days=2), "refund_amount", 1.0),
    (None, "refund_amount", 1.0),
    (NOW, None, 1.0),
]


def commerce(spark, *rows):
    return spark.createDataFrame([(w, w, n, v, None) for w, n, v in rows],
                                 schemas.table_schema("gold.commerce_kpis_1m"))


def market(spark, *rows):
    return spark.createDataFrame([(w, w, s, n, v, None) for w, s, n, v in rows],
                                 schemas.table_schema("gold.crypto_market_kpis_1m"))


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_one_good_row_is_enough(spark):
    got = suite_result(commerce(spark, GOOD, *BAD), COMMERCE_SUITE, now())
    assert values(got) == [("gold_commerce_kpis_suite", 1, True)]
    got = suite_result(commerce(spark, *BAD), COMMERCE_SUITE, now())
    assert values(got) == [("gold_commerce_kpis_suite", 0, False)]
    assert values(suite_result(commerce(spark), COMMERCE_SUITE, now()))[0][1:] == (0, False)


def test_lookback_includes_its_edge(spark):
    edge = NOW - timedelta(days=1)
    rows = [(edge, "refund_amount", 0.0), (edge - timedelta(seconds=1), "refund_amount", 0.0)]
    assert suite_result(commerce(spark, *rows), COMMERCE_SUITE, now()).first()["observed_rows"] == 1


def test_market_suite_needs_a_symbol(spark):
    df = market(spark, (NOW, "BTC-USD", "vwap_1m", 0.0), (NOW, None, "vwap_1m", 1.0),
                (NOW, "BTC-USD", "orders_created", 1.0))
    assert values(suite_result(df, MARKET_SUITE, now())) == [
        ("gold_crypto_market_kpis_suite", 1, True)]


def test_checkpoint_passes_when_all_suites_do(spark):
    good = suite_result(commerce(spark, GOOD), COMMERCE_SUITE, now())
    bad = suite_result(market(spark), MARKET_SUITE, now())
    rows = {r["suite"]: (r["observed_rows"], r["success"]) for r in checkpoint(good, bad).collect()}
    assert rows == {"gold_commerce_kpis_suite": (1, True),
                    "gold_crypto_market_kpis_suite": (0, False), CHECKPOINT: (1, False)}
    both = checkpoint(good, suite_result(market(spark, (NOW, "A", "vwap_1m", 1.0)), MARKET_SUITE, now()))
    assert all(r["success"] for r in both.collect())


def test_rejected_rows_are_counted_per_rule(spark):
    got = rejected_rows(commerce(spark, GOOD, *BAD), COMMERCE_SUITE, now())
    assert values(got, "rule", "rejected_rows") == [
        ("known_metric", 2), ("not_negative", 2), ("recent", 2), ("window_start_present", 1)]
    empty = rejected_rows(commerce(spark), COMMERCE_SUITE, now())
    assert {r["rejected_rows"] for r in empty.collect()} == {0}


def test_rules_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "kpis")
    commerce(spark, GOOD).write.parquet(path)
    df = suite_result(spark.read.parquet(path), COMMERCE_SUITE, now())
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(window_start" in pushed and "IsNotNull(metric_value)" in pushed


def test_conservation(spark):
    assert values(conservation([spark.range(2), spark.range(3)], spark.range(5))) == [(5, 5, True)]
    assert values(conservation([spark.range(2)], spark.range(5))) == [(2, 5, False)]


def test_contents_tell_a_swap_from_equal_counts(spark):
    ddl = "entity_type string, event_time timestamp_ntz, event_id string, amount decimal(12,2)"
    day = datetime(2026, 3, 13, 12)
    rows = [("order", day, "1", None), ("order", day, "2", None), ("order", day, None, None),
            ("order", None, "3", None), ("refund", day, "1", None)]

    def compared(found):
        df = content_conservation(
            spark.createDataFrame(rows, ddl), spark.createDataFrame(found, ddl),
            ("entity_type", "event_time", "event_id", "amount"))
        return {(r[0], r[1] and r[1].day): tuple(r[2:]) for r in df.collect()}

    same = {("order", 13): (3, 3, True), ("order", None): (1, 1, True),
            ("refund", 13): (1, 1, True)}
    assert compared(rows[::-1]) == same
    swap = [rows[0], rows[0], *rows[2:]]
    assert compared(swap) == same | {("order", 13): (3, 3, False)}
    moved = [rows[0], rows[1], ("order", day, None, Decimal("1.00")), *rows[3:]]
    assert compared(moved) == same | {("order", 13): (3, 3, False)}
    assert compared(rows[:-1]) == same | {("refund", 13): (1, 0, False)}
    assert compared([*rows, ("refund", None, "7", None)]) == same | {("refund", None): (0, 1, False)}
    assert all(not r[2] for r in compared([]).values())


def test_a_null_is_no_empty_place_in_the_mark(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    marks = df.groupBy("x", "y").agg(fingerprint("x", "y").alias("m")).select("m").distinct()
    assert marks.count() == 2


def test_results_are_kept_per_run(spark, lake):
    at = datetime(2026, 3, 13, 12, 0)
    lake.append(commerce(spark, GOOD), "gold.commerce_kpis_1m", "w", 0)
    lake.append(market(spark, (at, "A", "vwap_1m", 1.0)), "gold.crypto_market_kpis_1m", "w", 0)
    assert run_checks(lake, now()).where(F.col("suite") == CHECKPOINT).first()["success"]
    assert record(lake, 1, now())
    assert record(lake, 2, now() + F.expr("INTERVAL 5 DAY")) is False
    assert record(lake, 3, now())
    rows = history(lake).where(F.col("suite") == CHECKPOINT).orderBy("checked_at").collect()
    assert sorted(r["success"] for r in rows) == [False, True, True]
    assert history(lake).count() == 9
