"""Event-time watermarks of the feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark import schemas

TIME_COLUMN = {"ticks": "event_ts"}


def watermarked(df: DataFrame, feed: str, delay: str | None = None) -> DataFrame:
    """Allow rows of ``feed`` to be late by ``delay`` (each feed has its own default).

    The watermark is the highest event time over all partitions of the feed minus the
    delay, so a partition that falls silent does not hold windows back.
    """
    return df.withWatermark(TIME_COLUMN.get(feed, "event_time"), delay or schemas.WATERMARKS[feed])
