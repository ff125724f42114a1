"""KPI layer: one-minute metrics in long form.

Counts are over change records, as the tables define them:

- ``orders_created`` and ``gross_order_value`` take op ``c`` only, so rows of the initial
  snapshot (op ``r``) do not count.
- ``payments_succeeded`` counts every record that says SUCCEEDED, updates included.
- ``refund_amount`` adds every refund record, whatever its op or status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import (
    count_where,
    null_safe_sum,
    processing_time,
    ratio_or_zero,
    to_wall_clock,
)
from tidemark.operators.layout import conform, long_metrics
from tidemark.operators.silver import bar_aggregates, stored_bars
from tidemark.operators.windows import tumble

SECOND, MINUTE = "1 second", "1 minute"


def _long(wide: DataFrame, keys: list[str], metrics: tuple[str, ...], table: str,
          zone: str) -> DataFrame:
    rows = long_metrics(wide, ["window_start", "window_end", *keys], metrics)
    return conform(rows.withColumn("produced_at", processing_time(zone)), table)


def order_kpis(orders: DataFrame, zone: str = schemas.LOCAL_ZONE,
               op: str = "__op") -> DataFrame:
    """Created orders and their value.

    A batch drops other operations before the shuffle. A stream must not: the optimizer
    moves such a filter below the watermark, which would then stop at the last created
    order. There the condition is inside the aggregates, and minutes without a created
    order are left out afterwards.
    """
    created = F.col(op) == "c"
    if not orders.isStreaming:
        orders = orders.where(created)
    wide = tumble(orders, "event_time", MINUTE, [], [
        count_where(created).alias("orders_created"),
        null_safe_sum(F.when(created, F.col("total_amount"))).alias("gross_order_value"),
    ], zone).where(F.col("orders_created") > 0)
    return _long(wide, [], schemas.ORDER_METRICS, "gold.commerce_kpis_1m", zone)


def payment_kpis(payments: DataFrame, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """Payment records that say SUCCEEDED; streams as in ``order_kpis``."""
    succeeded = F.col("payment_status") == "SUCCEEDED"
    if not payments.isStreaming:
        payments = payments.where(succeeded)
    wide = tumble(payments, "event_time", MINUTE, [], [
        count_where(succeeded).alias("payments_succeeded"),
    ], zone).where(F.col("payments_succeeded") > 0)
    return _long(wide, [], schemas.PAYMENT_METRICS, "gold.commerce_kpis_1m", zone)


def refund_kpis(refunds: DataFrame, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    wide = tumble(refunds, "event_time", MINUTE, [], [
        null_safe_sum("refund_amount").alias("refund_amount"),
    ], zone)
    return _long(wide, [], schemas.REFUND_METRICS, "gold.commerce_kpis_1m", zone)


def commerce_kpis(orders: DataFrame, payments: DataFrame, refunds: DataFrame,
                  zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """All commerce metrics. For batches; a stream runs one query per feed, because an
    idle feed would hold back the common watermark."""
    return (
        order_kpis(orders, zone)
        .unionByName(payment_kpis(payments, zone))
        .unionByName(refund_kpis(refunds, zone))
    )


def market_kpis(ticks: DataFrame, zone: str = schemas.LOCAL_ZONE,
                time: str = "event_ts") -> DataFrame:
    """Market metrics per symbol straight from ticks. Volatility is the price range."""
    wide = tumble(ticks, time, MINUTE, ["symbol"], [
        F.count("*").alias("tick_count_1m"),
        null_safe_sum("volume").alias("traded_volume_1m"),
        null_safe_sum("trade_notional").alias("traded_notional_1m"),
        ratio_or_zero("trade_notional", "volume").alias("vwap_1m"),
        (F.max("price") - F.min("price")).alias("price_volatility_1m"),
    ], zone)
    return _long(wide, ["symbol"], schemas.MARKET_METRICS, "gold.crypto_market_kpis_1m", zone)


def _kpis_of_bars() -> list[Column]:
    return [
        F.sum("tick_count").alias("tick_count_1m"),
        null_safe_sum("traded_volume").alias("traded_volume_1m"),
        null_safe_sum("traded_notional").alias("traded_notional_1m"),
        ratio_or_zero("traded_notional", "traded_volume").alias("vwap_1m"),
        (F.max("max_price") - F.min("min_price")).alias("price_volatility_1m"),
    ]


def market_kpis_from_bars(bars: DataFrame, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    """The same metrics from one-second bars.

    A backfill that has just written the bars reads them instead of all ticks. Counts and
    price ranges are equal; sums of doubles may differ in the last place. Stored bars have
    wall-clock times: where a clock goes back, two of them may be the same, and minutes must
    be made from the instants of ticks (``market_kpis``), as ``backfill`` does there.
    """
    wide = tumble(bars, "window_start", MINUTE, ["symbol"], _kpis_of_bars(), zone)
    return _long(wide, ["symbol"], schemas.MARKET_METRICS, "gold.crypto_market_kpis_1m", zone)


def chained_minutes(ticks: DataFrame, time: str = "event_ts") -> DataFrame:
    """Minutes per symbol, each with its metrics and the one-second bars they are made of.

    Two windows in one plan: ticks are read once, and the second window is cut on the times
    of the first one's. A minute holds at most 60 bars per exchange.
    """
    bars = ticks.groupBy(F.window(time, SECOND).alias("second"), "symbol", "exchange").agg(
        *bar_aggregates())
    columns = [c for c in bars.columns if c != "symbol"]
    timed = bars.withColumn("at", F.window_time("second"))
    return timed.groupBy(F.window("at", MINUTE).alias("minute"), "symbol").agg(
        *_kpis_of_bars(), F.collect_list(F.struct(*columns)).alias("bars"))


def _edges(window: str, zone: str) -> list[Column]:
    return [to_wall_clock(F.col(f"{window}.{side}"), zone).alias(f"window_{side}")
            for side in ("start", "end")]


def bars_of_minutes(minutes: DataFrame, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    bars = minutes.select("symbol", F.inline("bars"))
    return stored_bars(bars.select(*_edges("second", zone), "*"), zone)


def kpis_of_minutes(minutes: DataFrame, zone: str = schemas.LOCAL_ZONE) -> DataFrame:
    wide = minutes.select(*_edges("minute", zone), "*")
    return _long(wide, ["symbol"], schemas.MARKET_METRICS, "gold.crypto_market_kpis_1m", zone)
