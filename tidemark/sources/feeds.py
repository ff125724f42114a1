"""Feed readers. The same call gives a stream or, for backfill, a bounded batch."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sources.decode import (
    computed_columns,
    decode_framed_avro,
    decode_json,
    require_columns,
)

SLACK = timedelta(hours=1)
AVRO_FEEDS = ("behavior", "ticks")
RECORD_TIME = "record_time"


def kafka_options(feed: str, servers: str, *, streaming: bool = True,
                  max_offsets: int | None = None, min_partitions: int | None = None,
                  start: datetime | None = None, end: datetime | None = None,
                  slack: timedelta | None = SLACK, **extra: str) -> dict[str, str]:
    """Options of the broker source: read from the earliest offset, and fail on lost data.

    ``start`` and ``end`` bound a batch by record time, widened by ``slack``: event times
    may lie that far from the time the broker got the record. Without slack the whole topic
    is read.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": schemas.TOPICS[feed],
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if not streaming:
        options["endingOffsets"] = "latest"
        if start is not None and slack is not None:
            del options["startingOffsets"]
            options["startingTimestamp"] = f"{round((start - slack).timestamp() * 1000)}"
            options["startingOffsetsByTimestampStrategy"] = "latest"
        if end is not None and slack is not None:
            del options["endingOffsets"]
            options["endingTimestamp"] = f"{round((end + slack).timestamp() * 1000)}"
    elif max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options | extra


def kafka_feed(spark: SparkSession, feed: str, servers: str, *, streaming: bool = True,
               **options) -> DataFrame:
    """Raw messages of a feed's topic. Needs the Kafka connector package on the cluster."""
    reader = spark.readStream if streaming else spark.read
    settings = kafka_options(feed, servers, streaming=streaming, **options)
    return reader.format("kafka").options(**settings).load()


def file_feed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", *,
              streaming: bool = True, max_files: int | None = None) -> DataFrame:
    """Rows or messages of a feed kept as files; all files present are read first."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).schema(schema)
    if streaming and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def open_feed(raw: DataFrame, feed: str, *, decoded: bool = False,
              writers: dict[int, str] | None = None, record_time: bool = False) -> DataFrame:
    """Typed feed rows with computed columns; a NULL where the feed declares none fails.

    ``raw`` holds broker messages (``value``, ``timestamp``) or, with ``decoded``, rows that
    already have the feed's columns. ``writers`` maps registry ids to writer schemas.
    ``record_time`` keeps the messages' time beside the rows, under that name; the behaviour
    feed takes it as its event time anyway.
    """
    kept = ("timestamp",) if record_time else ()
    if decoded:
        rows = raw
    elif feed not in AVRO_FEEDS:
        rows = decode_json(raw, schemas.feed_schema(feed), keep=kept)
    elif feed == "behavior":
        # The payload's own event_time gives way to the record timestamp.
        rows = decode_framed_avro(raw, feed, keep=("timestamp",), writers=writers)
        rows = rows.drop("event_time")
    else:
        rows = decode_framed_avro(raw, feed, keep=kept, writers=writers)
    if kept and not decoded and feed != "behavior":
        rows = rows.withColumnRenamed("timestamp", RECORD_TIME)
    return computed_columns(require_columns(rows, feed), feed)
