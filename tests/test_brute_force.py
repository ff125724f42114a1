"""Windowed results against plain Python over random rows, before and after 1970."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from rows import feed, money

from tidemark.operators import market_kpis, refund_kpis, tick_bars

EPOCH = datetime(1970, 1, 1)


def floor(ms, size):
    return EPOCH + timedelta(milliseconds=ms // size * size)


@pytest.fixture(params=[0, 1_773_370_800_000, -86_400_000])
def ticks(request):
    rng = random.Random(request.param)
    # One symbol has two thirds of the rows.
    return [(f"t{i}", rng.choice(["A", "A", "B"]), rng.choice(["x", "y"]),
             rng.randint(1, 400) / 4, rng.choice([0.0, 0.5, 2.0]),
             rng.choice(["BUY", "SELL", "CROSS"]), "", "test",
             request.param + rng.randint(-90_000, 90_000)) for i in range(600)]


def grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def test_bars(spark, ticks):
    want = grouped(ticks, lambda r: (floor(r[8], 1000), r[1], r[2]))
    got = tick_bars(feed(spark, "ticks", ticks), "UTC").collect()
    assert {(b["window_start"], b["symbol"], b["exchange"]) for b in got} == want.keys()
    for bar in got:
        rows = want[bar["window_start"], bar["symbol"], bar["exchange"]]
        price, volume = [r[3] for r in rows], sum(r[4] for r in rows)
        notional = sum(r[3] * r[4] for r in rows)
        assert bar["window_end"] - bar["window_start"] == timedelta(seconds=1)
        assert (bar["tick_count"], bar["min_price"], bar["max_price"]) == (
            len(rows), min(price), max(price))
        assert bar["avg_price"] == pytest.approx(sum(price) / len(rows))
        assert bar["traded_volume"] == volume and bar["traded_notional"] == pytest.approx(notional)
        assert bar["vwap"] == pytest.approx(notional / volume if volume else 0.0)
        assert bar["buy_tick_count"] == sum(r[5] == "BUY" for r in rows)
        assert bar["sell_tick_count"] == sum(r[5] == "SELL" for r in rows)


def test_market_metrics(spark, ticks):
    want = {}
    for (start, symbol), rows in grouped(ticks, lambda r: (floor(r[8], 60_000), r[1])).items():
        price, volume = [r[3] for r in rows], sum(r[4] for r in rows)
        notional = sum(r[3] * r[4] for r in rows)
        for name, value in (("tick_count_1m", len(rows)), ("traded_volume_1m", volume),
                            ("traded_notional_1m", notional),
                            ("vwap_1m", notional / volume if volume else 0.0),
                            ("price_volatility_1m", max(price) - min(price))):
            want[start, symbol, name] = value
    got = {(r["window_start"], r["symbol"], r["metric_name"]): r["metric_value"]
           for r in market_kpis(feed(spark, "ticks", ticks), "UTC").collect()}
    assert got == pytest.approx(want)


def test_refunds(spark, ticks):
    rows = [(i, i, None, 7, "REQUESTED", None, None if r[4] == 0 else round(r[3] * r[4]),
             r[8], r[8] if i % 2 else None, "c", None) for i, r in enumerate(ticks)]
    want = {start: float(sum(r[6] or 0 for r in group))
            for start, group in grouped(rows, lambda r: floor(r[7], 60_000)).items()}
    typed = [(*r[:6], money(r[6]), *r[7:]) for r in rows]
    got = {r["window_start"]: r["metric_value"]
           for r in refund_kpis(feed(spark, "refunds", typed), "UTC").collect()}
    assert got == want
