"""Bounded batch reprocessing with the transforms the streams use.

Each feed is decoded into its raw table. The later layers are computed from
the columns of that batch, and the one-minute market metrics from the one-second bars, so
the messages are never decoded again and ticks are shuffled once. Feeds run side by side.

Ranges may be cut anywhere: a window belongs to the range that holds its start, and is
computed from all its rows. Adjacent ranges thus give what one long range gives. Where a
bound lies within a minute, the feed is read a second time (ticks: a third time) for the rows
up to the end of that minute; so it is where the lake's zone sets its clock back within the
range, since stored times don't tell the two passes of the repeated hour apart.

The broker is asked for a range by record time, widened by a slack, so a record whose event
time lies further than the slack from its record time may be missing from every range. Feeds
that carry their record time (``open_feed(record_time=True)``) are checked for such strays in
the pass that stores them. Strays that were read tell of others that were not: the run reports
them and, above ``max_strays``, commits nothing of the feed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clock_goes_back
from tidemark.operators.bronze import CHANGE_TABLES, bronze_behavior, bronze_changes, bronze_ticks
from tidemark.operators.gold import (
    market_kpis,
    market_kpis_from_bars,
    order_kpis,
    payment_kpis,
    refund_kpis,
)
from tidemark.operators.silver import entity_events, silver_behavior, tick_bars
from tidemark.plans.lake import Lake, in_zone
from tidemark.plans.together import together
from tidemark.sources.feeds import RECORD_TIME, SLACK
from tidemark.streaming.watermarks import TIME_COLUMN


class StraysError(ValueError):
    """Too many records lie further from their record time than the slack."""


class Strays:
    """Counts records by the distance of event time and record time, as they pass."""

    def __init__(self, feed: str, slack: timedelta, limit: int | None):
        self.feed, self.slack, self.limit = feed, slack, limit
        self.observed = Observation(f"strays-{feed}-{uuid.uuid4().hex}")
        self.found: dict | None = None

    def watch(self, opened: DataFrame) -> DataFrame:
        event = F.unix_millis(F.col(TIME_COLUMN.get(self.feed, "event_time")))
        apart = event - F.unix_millis(F.col(RECORD_TIME))
        slack = self.slack // timedelta(milliseconds=1)
        far = F.abs(apart) > slack
        return opened.observe(
            self.observed, F.count(F.lit(1)).alias("records"),
            F.count_if(far & (apart < 0)).alias("event_before_record"),
            F.count_if(far & (apart > 0)).alias("event_after_record"),
            F.count_if(far & (F.abs(apart) > 86_400_000)).alias("over_a_day"),
            F.max(F.when(far, F.abs(apart))).alias("farthest_ms"))

    def verify(self) -> None:
        self.found = {"feed": self.feed, **self.observed.get}
        strays = self.found["event_before_record"] + self.found["event_after_record"]
        if self.limit is not None and strays > self.limit:
            raise StraysError(
                f"{strays} records of {self.feed} lie further than {self.slack} from their record "
                f"time, up to {self.found['farthest_ms']} ms; widen the slack or read without it")


REPORT = ("feed string, records bigint, event_before_record bigint, event_after_record bigint, "
          "over_a_day bigint, farthest_ms bigint")


def in_range(df: DataFrame, feed: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with event time in ``[start, end)``; the bounds are instants."""
    time = F.col(TIME_COLUMN.get(feed, "event_time"))
    if start is not None:
        df = df.where(time >= F.lit(start))
    if end is not None:
        df = df.where(time < F.lit(end))
    return df


def with_event_time(bronze: DataFrame, feed: str) -> DataFrame:
    """Raw change rows with the event time they were received under."""
    stamp = CHANGE_TABLES[feed][1]
    return bronze.withColumn("event_time", F.coalesce("cdc_source_ts", "updated_at", stamp))


def ceiling(when: datetime | None, **step: int) -> datetime | None:
    """The first whole step at or after ``when``."""
    if when is None:
        return None
    size = timedelta(**step)
    past = (when - datetime(1970, 1, 1, tzinfo=when.tzinfo)) % size
    return when if not past else when + (size - past)


def writer_name(lake: Lake, run: str, start: datetime | None, end: datetime | None) -> str:
    """The writer of a run. A run's name stands for one range: another one is an error."""
    def shown(when: datetime | None) -> str:
        return "all" if when is None else f"{round(when.timestamp() * 1_000_000)}"

    writer = f"backfill-{run}--{shown(start)}--{shown(end)}--"
    others = lake.writers(f"backfill-{run}--").where(~F.col("writer").startswith(writer))
    if not others.isEmpty():
        raise ValueError(f"run {run!r} was used for another range; choose a new name")
    return writer


def backfill(lake: Lake, feeds: dict[str, DataFrame], run: str,
             start: datetime | None = None, end: datetime | None = None,
             slack: timedelta = SLACK, max_strays: int | None = None) -> DataFrame:
    """Append a range of ``feeds`` (opened, bounded) to all layers under the name ``run``.

    Each table gets one commit. Repeating a run that broke off does only what is missing.
    Bounds without a zone are in the lake's. Gives the strays (see above) of the feeds that
    carry a record time and were stored by this call, a row per feed (``REPORT``).
    """
    zone = lake.zone
    start, end = (None if t is None else in_zone(t, zone) for t in (start, end))
    writer = writer_name(lake, run, start, end)
    minutes = ceiling(start, minutes=1), ceiling(end, minutes=1)
    seconds = ceiling(start, seconds=1), ceiling(end, seconds=1)
    whole = minutes == (start, end)

    def timely(raw: DataFrame) -> bool:
        """Whether windows may be cut on stored event times: no bound lies within a minute, and
        no wall-clock time of these days stands for two instants."""
        if not whole:
            return False
        days = raw.agg(F.min("event_time").cast("date"), F.max("event_time").cast("date")).first()
        return days[0] is None or not clock_goes_back(zone, *days)

    def put(df: DataFrame, table: str, part: str = "", strays: Strays | None = None) -> DataFrame:
        name = writer + part
        lake.append(df, table, name, 0, spread=True, verify=strays and strays.verify)
        return lake.read_batch(table, name, 0)

    def watched(opened: DataFrame, feed: str) -> tuple[DataFrame, Strays | None]:
        if RECORD_TIME not in opened.columns:
            return opened, None
        strays = Strays(feed, slack, max_strays)
        checked.append(strays)
        return strays.watch(opened), strays

    checked: list[Strays] = []

    def changes(feed: str, opened: DataFrame) -> None:
        seen, strays = watched(opened, feed)
        rows = in_range(seen, feed, start, end)
        raw = put(bronze_changes(rows, feed, zone), CHANGE_TABLES[feed][0], strays=strays)
        raw = with_event_time(raw, feed)
        timed, op = (raw, "cdc_op") if timely(raw) else (in_range(opened, feed, *minutes), "__op")
        kpis = {
            "orders": lambda: order_kpis(timed, zone, op=op),
            "payments": lambda: payment_kpis(timed, zone),
            "refunds": lambda: refund_kpis(timed, zone),
        }[feed]
        together(
            lake.spark,
            lambda: put(entity_events(raw, feed, zone), "silver.order_events", f"-{feed}"),
            lambda: put(kpis(), "gold.commerce_kpis_1m", f"-{feed}"))

    def ticks(opened: DataFrame) -> None:
        seen, strays = watched(opened, "ticks")
        raw = put(bronze_ticks(in_range(seen, "ticks", start, end), zone), "bronze.crypto_ticks",
                  strays=strays)
        if timely(raw):
            bars = put(tick_bars(raw, zone, time="event_time"), "silver.crypto_ticks_1s")
            put(market_kpis_from_bars(bars, zone), "gold.crypto_market_kpis_1m")
        else:
            put(tick_bars(in_range(opened, "ticks", *seconds), zone), "silver.crypto_ticks_1s")
            put(market_kpis(in_range(opened, "ticks", *minutes), zone), "gold.crypto_market_kpis_1m")

    def behavior(opened: DataFrame) -> None:
        rows = in_range(opened, "behavior", start, end)
        raw = put(bronze_behavior(rows, zone), "bronze.user_behavior_events")
        put(silver_behavior(raw), "silver.user_behavior")

    def chain(feed: str, opened: DataFrame) -> Callable[[], None]:
        if feed in CHANGE_TABLES:
            return lambda: changes(feed, opened)
        return {"ticks": lambda: ticks(opened), "behavior": lambda: behavior(opened)}[feed]

    together(lake.spark, *[chain(feed, df) for feed, df in feeds.items()])
    rows = sorted((s.found for s in checked if s.found), key=lambda r: r["feed"])
    names = T.StructType.fromDDL(REPORT).names
    return lake.spark.createDataFrame([tuple(r[n] for n in names) for r in rows], REPORT)
