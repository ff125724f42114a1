from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import feed, order, payment, refund, tick, values

from tidemark import schemas
from tidemark.operators import (
    bronze_behavior,
    bronze_changes,
    bronze_ticks,
    commerce_kpis,
    market_kpis,
    market_kpis_from_bars,
    order_events,
    order_kpis,
    payment_kpis,
    refund_kpis,
    silver_behavior,
    tick_bars,
)


def at(minute, second=0):
    return datetime(2026, 3, 13, 12, minute, second)  # Seoul wall clock


def kpis(df):
    return {(r["window_start"], r["metric_name"]): r["metric_value"] for r in df.collect()}


@pytest.mark.parametrize("name,rows,table", [
    ("orders", [order(1, 5, 0)], "bronze.orders_cdc"),
    ("payments", [payment(1, 5, 0)], "bronze.payments_cdc"),
    ("refunds", [refund(1, 5, 0)], "bronze.refunds_cdc"),
])
def test_bronze_changes_match_their_table(spark, name, rows, table):
    df = bronze_changes(feed(spark, name, rows), name)
    assert df.schema.names == schemas.table_schema(table).names
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.table_schema(table)]
    row = df.first()
    assert row["cdc_op"] == "c" and row["cdc_source_ts"] == at(0)


def test_bronze_keeps_every_record(spark):
    rows = [order(1, 5, 0, op=o) for o in "rcud"] * 2
    assert bronze_changes(feed(spark, "orders", rows), "orders").count() == 8


def test_bronze_ticks(spark):
    row = bronze_ticks(feed(spark, "ticks", [tick(1, 10, 2, 1.5)])).first()
    assert row["event_time"] == datetime(2026, 3, 13, 12, 0, 1, 500000)
    assert row["trade_notional"] == 20.0


def test_behaviour_layers(spark):
    df = spark.createDataFrame(
        [("e", 1, "s", "CLICK", "home", 2, None, "cart", None, 1, 2.5, "mobile", "web",
          datetime(2026, 3, 13, 3, 0))], schemas.FEED_DDL["behavior"] + ", event_time TIMESTAMP")
    bronze = bronze_behavior(df)
    silver = silver_behavior(bronze)
    assert bronze.first()["event_time"] == at(0) and bronze.first()["cart_id"] == "cart"
    assert silver.schema.names == schemas.table_schema("silver.user_behavior").names
    assert "cart_id" not in silver.columns


def test_order_events_unify_three_entities(spark):
    df = order_events(feed(spark, "orders", [order(1, 5, 0), order(1, 5, 0)]),
                      feed(spark, "payments", [payment(2, 6, 1)]),
                      feed(spark, "refunds", [refund(3, None, 2)]))
    assert values(df, "event_id", "entity_type", "event_status", "amount", "event_time",
                  "source_system") == sorted([
        ("1", "order", "CREATED", Decimal("5.00"), at(0), "postgres_cdc"),
        ("1", "order", "CREATED", Decimal("5.00"), at(0), "postgres_cdc"),
        ("2", "payment", "SUCCEEDED", Decimal("6.00"), at(0, 1), "postgres_cdc"),
        ("3", "refund", "SUCCEEDED", None, at(0, 2), "postgres_cdc"),
    ], key=repr)


def test_bars(spark):
    df = tick_bars(feed(spark, "ticks", [
        tick(1, 10, 1, 0.0), tick(2, 20, 3, 0.999, "SELL"), tick(3, 5, 0, 0.5, "CROSS"),
        tick(4, 7, 1, 1.0),                       # exactly at the end: the next window
        tick(5, 9, 0, 0.1, symbol="ETH-USD"),     # nothing traded
    ]))
    rows = {(r["symbol"], r["window_start"]): r for r in df.collect()}
    bar = rows["BTC-USD", at(0, 0)]
    assert bar["window_end"] == at(0, 1)
    assert (bar["tick_count"], bar["buy_tick_count"], bar["sell_tick_count"]) == (3, 1, 1)
    assert (bar["min_price"], bar["max_price"]) == (5.0, 20.0)
    assert bar["avg_price"] == pytest.approx(35 / 3)
    assert (bar["traded_volume"], bar["traded_notional"], bar["vwap"]) == (4.0, 70.0, 17.5)
    assert rows["BTC-USD", at(0, 1)]["tick_count"] == 1
    assert rows["ETH-USD", at(0, 0)]["vwap"] == 0.0
    assert len(rows) == 3


def test_order_metrics_count_created_records_only(spark):
    got = kpis(order_kpis(feed(spark, "orders", [
        order(1, "89.90", 10), order(2, "245.00", 20), order(3, 100, 30, op="r"),
        order(1, "89.90", 40, op="u"), order(1, "89.90", 50, op="d"),
        order(4, 5, 70, op="u"),                  # a minute without a created order: no row
        order(5, None, 130),
    ])))
    assert got == {(at(0), "orders_created"): 2.0, (at(0), "gross_order_value"): 334.9,
                   (at(2), "orders_created"): 1.0, (at(2), "gross_order_value"): 0.0}


def test_payment_updates_count_again(spark):
    got = kpis(payment_kpis(feed(spark, "payments", [
        payment(1, 5, 0), payment(1, 5, 1, op="u"), payment(1, 5, 2, op="u"),
        payment(2, 5, 3, status="PENDING"), payment(3, 5, 60, status="PENDING"),
    ])))
    assert got == {(at(0), "payments_succeeded"): 3.0}


def test_refunds_of_any_status_add_up_and_null_is_zero(spark):
    got = kpis(refund_kpis(feed(spark, "refunds", [
        refund(1, 10, 0), refund(1, 10, 1, op="u"), refund(2, 5, 2, status="REQUESTED"),
        refund(3, None, 60), refund(4, None, 61),
    ])))
    assert got == {(at(0), "refund_amount"): 25.0, (at(1), "refund_amount"): 0.0}


def test_seed_scenario_at_one_source_time(spark):
    got = commerce_kpis(
        feed(spark, "orders", [order(1, "89.90", 0), order(2, "245.00", 0, coupon="FLASH15")]),
        feed(spark, "payments", [payment(1, "89.90", 0), payment(2, 245, 0, "PENDING"),
                                 payment(2, 245, 0, op="u")]),
        feed(spark, "refunds", [refund(1, "89.90", 0)]))
    assert got.schema.names == schemas.table_schema("gold.commerce_kpis_1m").names
    assert kpis(got) == {(at(0), "orders_created"): 2.0, (at(0), "gross_order_value"): 334.9,
                         (at(0), "payments_succeeded"): 2.0, (at(0), "refund_amount"): 89.9}


def market(df):
    return {(r["symbol"], r["window_start"], r["metric_name"]): r["metric_value"]
            for r in df.collect()}


TICKS = [tick(i, 10 + i % 7, i % 4, i * 0.7, ["BUY", "SELL"][i % 2],
              ["BTC-USD", "ETH-USD"][i % 2], ["binance", "bybit"][i % 3 % 2])
         for i in range(300)]


def test_market_metrics(spark):
    got = market(market_kpis(feed(spark, "ticks", [
        tick(1, 10, 1, 0), tick(2, 20, 3, 59.999, exchange="bybit"), tick(3, 9, 0, 60)])))
    assert got == {
        ("BTC-USD", at(0), "tick_count_1m"): 2.0, ("BTC-USD", at(0), "traded_volume_1m"): 4.0,
        ("BTC-USD", at(0), "traded_notional_1m"): 70.0, ("BTC-USD", at(0), "vwap_1m"): 17.5,
        ("BTC-USD", at(0), "price_volatility_1m"): 10.0,
        ("BTC-USD", at(1), "tick_count_1m"): 1.0, ("BTC-USD", at(1), "traded_volume_1m"): 0.0,
        ("BTC-USD", at(1), "traded_notional_1m"): 0.0, ("BTC-USD", at(1), "vwap_1m"): 0.0,
        ("BTC-USD", at(1), "price_volatility_1m"): 0.0,
    }


def test_market_has_five_rows_per_window_and_symbol(spark):
    df = market_kpis(feed(spark, "ticks", TICKS))
    groups = df.select("window_start", "symbol").distinct().count()
    assert df.count() == 5 * groups


def test_market_metrics_from_bars_agree(spark):
    ticks = feed(spark, "ticks", TICKS)
    direct, rolled = market(market_kpis(ticks)), market(market_kpis_from_bars(tick_bars(ticks)))
    assert direct.keys() == rolled.keys()
    assert all(rolled[k] == pytest.approx(v) for k, v in direct.items())


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_feeds_all_metrics(spark):
    plan = executed(market_kpis(feed(spark, "ticks", TICKS)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan and "Expand" in plan


def test_created_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    feed(spark, "orders", [order(1, 5, 0)]).write.parquet(path)
    plan = executed(order_kpis(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(__op), EqualTo(__op,c)" in plan
    assert "coupon_id" not in plan.split("ReadSchema")[1]


def test_windows_are_cut_in_utc_and_stored_in_the_zone(spark):
    ticks = feed(spark, "ticks", [tick(1, 1, 1, 61)])
    utc = market_kpis(ticks, "UTC").first()["window_start"]
    assert utc == datetime(2026, 3, 13, 3, 1)
    assert market_kpis(ticks).first()["window_start"] == at(1)
    stored = bronze_ticks(ticks)
    again = market_kpis(stored.withColumn("x", F.lit(1)), time="event_time")
    assert again.first()["window_start"] == at(1)
