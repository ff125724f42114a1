from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    clock_goes_back,
    count_where,
    epoch_ms_to_ts,
    first_event_time,
    hour_floor,
    mean,
    minute_floor,
    null_safe_sum,
    processing_time,
    ratio_or_zero,
    to_wall_clock,
    wall_clock,
    wall_clock_to_epoch_ms,
    zoned_instant,
)
from tidemark.session import scratch_dir

MS = 1700000000123
SEOUL = datetime(2023, 11, 15, 7, 13, 20, 123000)
UTC = datetime(2023, 11, 14, 22, 13, 20, 123000)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Seoul"])
def zoned(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_ms_to_wall_clock_in_any_session_zone(zoned):
    at = epoch_ms_to_ts(F.lit(MS))
    assert one(zoned, to_wall_clock(at, "Asia/Seoul")) == SEOUL
    assert one(zoned, to_wall_clock(at, "UTC")) == UTC
    assert one(zoned, to_wall_clock(epoch_ms_to_ts(F.lit(None).cast("bigint")), "UTC")) is None


def test_wall_clock_survives_hours_that_a_session_zone_skips_or_repeats(zoned):
    for text in ("2023-03-12 02:30:00.123", "2023-11-05 01:30:00", "1969-12-31 23:59:59.999"):
        ntz = F.lit(text).cast("timestamp_ntz")
        back = to_wall_clock(epoch_ms_to_ts(wall_clock_to_epoch_ms(ntz, "UTC")), "UTC")
        assert one(zoned, back == ntz)


def test_wall_clock_to_epoch_ms_in_a_zone(zoned):
    assert one(zoned, wall_clock_to_epoch_ms(F.lit(SEOUL).cast("timestamp_ntz"), "UTC")) is not None
    seoul = F.lit("2023-11-15 07:13:20.123").cast("timestamp_ntz")
    assert one(zoned, wall_clock_to_epoch_ms(seoul, "Asia/Seoul")) == MS


def test_wall_clock_cuts_to_milliseconds_and_passes_ntz_through(spark):
    df = spark.sql("SELECT timestamp_micros(1700000000123999) AS a, "
                   "TIMESTAMP_NTZ '2023-11-15 07:13:20.123456' AS b")
    row = df.select(wall_clock(df, "a", "UTC"), wall_clock(df, "b", "UTC")).first()
    assert row[0] == UTC
    assert row[1] == datetime(2023, 11, 15, 7, 13, 20, 123456)


def test_event_time_takes_the_first_known_column(spark):
    df = spark.createDataFrame([(1, 2, 3), (None, 2, 3), (None, None, 3), (None, None, None)],
                               "s bigint, u bigint, c bigint")
    got = df.select(F.unix_millis(first_event_time("s", "u", "c")).alias("v")).collect()
    assert [r["v"] for r in got] == [1, 2, 3, None]


def test_zoned_literal(spark):
    assert one(spark, F.unix_seconds(zoned_instant("2026-03-13 12:00:00 Asia/Seoul"))) == 1773370800


def test_processing_time_has_millisecond_precision(spark):
    assert one(spark, processing_time("UTC")).microsecond % 1000 == 0


def test_minute_floor(spark):
    at = minute_floor(F.lit("2026-03-13 12:00:59").cast("timestamp"))
    assert one(spark, F.unix_seconds(at) % 60) == 0


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0, "BUY"), ("a", 3.0, 2.0, None), ("z", 5.0, 0.0, "SELL"),
         ("n", None, None, None)],
        "k string, x double, y double, side string")
    got = {r["k"]: tuple(r)[1:] for r in df.groupBy("k").agg(
        null_safe_sum("x"), mean("x"), ratio_or_zero("x", "y"),
        count_where(F.col("side") == "BUY")).collect()}
    assert got["a"] == (4.0, 2.0, 1.0, 1)
    assert got["z"] == (5.0, 5.0, 0.0, 0)
    assert got["n"] == (0.0, None, None, 0)


class _Session:
    def __init__(self, **settings):
        self.settings, self.conf = settings, self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_goes_to_the_shared_folder_of_the_session():
    shared = _Session(**{"spark.checkpoint.dir": "s3a://shared/", "spark.master": "yarn"})
    one, two = scratch_dir(shared), scratch_dir(shared)
    assert one.startswith("s3a://shared/run-") and one != two
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_Session(**{"spark.master": "yarn"}))
    assert "tidemark-" in scratch_dir(_Session(**{"spark.master": "local[4]"}))


def test_clocks_that_go_back():
    autumn = date(2026, 11, 1)
    assert clock_goes_back("America/New_York", autumn, autumn)
    assert not clock_goes_back("America/New_York", date(2026, 2, 1), date(2026, 10, 29))
    assert clock_goes_back("Australia/Lord_Howe", date(2026, 4, 1), date(2026, 4, 8))
    assert not clock_goes_back("Asia/Seoul", date(1992, 1, 1), date(2026, 12, 31))
    assert not clock_goes_back("UTC", date.min, date.min) and not clock_goes_back(
        "UTC", date.max, date.max)


def test_hours_in_any_session_zone(zoned):
    for at, want in ((datetime(2026, 3, 8, 2, 59, 59, 999000), datetime(2026, 3, 8, 2)),
                     (datetime(1969, 12, 31, 23, 30), datetime(1969, 12, 31, 23))):
        stamp = F.lit(at.isoformat(" ")).cast("timestamp_ntz")
        assert one(zoned, hour_floor(stamp)) == want
