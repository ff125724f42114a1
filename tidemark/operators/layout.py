"""Row layouts shared by the layers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

from pyspark.sql import DataFrame

from tidemark import schemas


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in declared order and type."""
    return df.selectExpr(*_casts(table))


@cache
def _casts(table: str) -> tuple[str, ...]:
    return tuple(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
                 for f in schemas.table_schema(table))


def long_metrics(df: DataFrame, keys: Iterable[str], metrics: Iterable[str]) -> DataFrame:
    """One row per key and metric from one row per key.

    One aggregate feeds every metric, so the input is scanned and shuffled once however
    many metrics there are.
    """
    keys, metrics = list(keys), list(metrics)
    wide = df.selectExpr(*keys, *[f"CAST({m} AS DOUBLE) AS {m}" for m in metrics])
    return wide.unpivot(keys, metrics, "metric_name", "metric_value")
