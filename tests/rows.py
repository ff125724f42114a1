"""Hand-written feed rows."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from tidemark import schemas
from tidemark.sources import computed_columns

BASE = datetime(2026, 3, 13, 3, 0, tzinfo=timezone.utc)  # 12:00 in Seoul
BASE_MS = int(BASE.timestamp() * 1000)


def ms(seconds: float) -> int:
    return BASE_MS + int(seconds * 1000)


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def order(key, amount, at, op="c", status="CREATED", coupon=None):
    return (key, 7, status, money(amount), "KRW", coupon, ms(at), ms(at), op, ms(at))


def payment(key, amount, at, status="SUCCEEDED", op="c"):
    return (key, key, 7, status, "CARD", money(amount), ms(at), ms(at), op, ms(at))


def refund(key, amount, at, status="SUCCEEDED", op="c"):
    return (key, key, key, 7, status, "CUSTOMER_CHANGED_MIND", money(amount), ms(at), ms(at),
            op, ms(at))


def tick(key, price, volume, at, side="BUY", symbol="BTC-USD", exchange="binance"):
    return (f"t{key}", symbol, exchange, float(price), float(volume), side, f"x{key}", "test",
            ms(at))


def feed(spark, name, rows):
    """Rows of a feed with its computed columns."""
    return computed_columns(spark.createDataFrame(rows, schemas.feed_schema(name)), name)


def values(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
