"""Tumbling event-time windows, for batches and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import to_wall_clock


def tumble(df: DataFrame, time: str, size: str, keys: list[str], aggregates: list[Column],
           zone: str) -> DataFrame:
    """Aggregate ``df`` over half-open ``[start, end)`` windows of ``size`` and ``keys``.

    Windows are cut on the instant and turned into wall-clock ``window_start`` and
    ``window_end`` afterwards; a wall-clock input keeps its clock. A group without rows
    gives no row. On a stream, set the watermark on ``time`` first: a window is then
    emitted once, when the watermark passes its end.
    """
    grouped = df.groupBy(F.window(time, size).alias("w"), *keys).agg(*aggregates)
    local = isinstance(df.schema[time].dataType, T.TimestampNTZType)

    def edge(side: str) -> Column:
        value = F.col(f"w.{side}")
        return (value if local else to_wall_clock(value, zone)).alias(f"window_{side}")

    rest = [c for c in grouped.columns if c != "w"]
    return grouped.select(edge("start"), edge("end"), *rest)
