"""Message bodies to typed feed rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import epoch_ms_to_ts, first_event_time

CORRUPT = "_corrupt_record"
JSON_SPACE = " \t\r\n"
FRAME_HEADER_BYTES = 5  # one marker byte, four bytes of schema id


def _is_json_object(value: Column) -> Column:
    return F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT")


def decode_json(df: DataFrame, schema: T.StructType, value: str = "value",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Tolerant decode of JSON objects into the columns of ``schema``.

    A field that cannot be read is NULL and its siblings stay. A record that is not a
    JSON object (broken text, ``null``, an array, a scalar, no value) is left out; an
    empty object is a row of NULLs. ``keep`` names columns of ``df`` to carry along.

    The record is parsed once. A reader error alone does not tell a bad field from a bad
    record, so the few rows with an error are looked at again; the others never are.
    """
    text = F.col(value).cast("string")
    parsed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(
        text, parsed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    looks_like_object = F.ltrim(text, F.lit(JSON_SPACE)).startswith("{")
    # inline() gives a row for one record and none for NULL. It also holds the record, so
    # the filter below cannot be pushed beneath it and parse the text a second time.
    rows = df.select(*keep, F.inline(F.when(looks_like_object, F.array(record))))
    readable = F.col(CORRUPT).isNull() | _is_json_object(F.col(CORRUPT))
    return rows.where(readable).drop(CORRUPT)


def avro_reader_schema(feed: str) -> str:
    """Avro record schema of an event feed as JSON text."""
    name, fields = schemas.AVRO_RECORDS[feed]
    body = []
    for field, kind in fields.items():
        entry: dict = {"name": field, "type": kind}
        if isinstance(kind, list):
            entry["default"] = None
        body.append(entry)
    return json.dumps({"type": "record", "name": name, "fields": body})


def avro_body(value: Column) -> Column:
    """Message without its frame header."""
    return F.substring(value, FRAME_HEADER_BYTES + 1, 2**31 - 1)


def avro_schema_id(value: Column) -> Column:
    """Writer schema id in the frame header."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")


def _unframed(value: Column) -> Column:
    """Start of a decoder's branches: a message with another marker byte fails the job."""
    return F.when(F.hex(F.substring(value, 1, 1)) != "00",
                  F.raise_error(F.lit("message has no registry frame")))


def framed_body(value: Column) -> Column:
    """Body of a framed message."""
    return _unframed(value).otherwise(avro_body(value))


def by_writer(value: Column, writers: dict[int, str], decode) -> Column:
    """``decode(body, writer schema)`` with the schema that the frame's id names.

    A message with an unknown id fails the job.
    """
    number, body = avro_schema_id(value), avro_body(value)
    branches = _unframed(value)
    for known, schema in writers.items():
        branches = branches.when(number == known, decode(body, schema))
    unknown = F.concat(F.lit("no writer schema with id "), number.cast("string"))
    return branches.when(value.isNotNull(), F.raise_error(unknown))


def decode_framed_avro(df: DataFrame, feed: str, value: str = "value",
                       keep: tuple[str, ...] = (),
                       writers: dict[int, str] | None = None) -> DataFrame:
    """Decode registry-framed Avro. Needs the ``spark-avro`` package on the cluster.

    With ``writers``, each message is read by the schema it was written with and resolved
    to today's; without, all of them must have been written with today's.
    """
    from pyspark.sql.avro.functions import from_avro

    reader = avro_reader_schema(feed)

    def decode(body: Column, schema: str) -> Column:
        return from_avro(body, schema, {"mode": "FAILFAST", "avroSchema": reader})

    message = F.col(value)
    record = (decode(framed_body(message), reader) if writers is None
              else by_writer(message, writers, decode))
    return df.select(*keep, F.inline(F.array(record)))


def computed_columns(df: DataFrame, feed: str) -> DataFrame:
    """Add the columns each feed derives from its payload.

    Change feeds get their instants and an event time that falls through source time,
    update time and business time. Ticks get an instant and the trade notional. Behaviour
    events take the record timestamp as event time, whatever the payload says.
    """
    business = {"orders": "created_at", "payments": "paid_at", "refunds": "refunded_at"}
    if feed in business:
        stamp = business[feed]
        return df.withColumns({
            stamp: epoch_ms_to_ts(f"{stamp}_ms"),
            "updated_at": epoch_ms_to_ts("updated_at_ms"),
            "event_time": first_event_time("__source_ts_ms", "updated_at_ms", f"{stamp}_ms"),
        })
    if feed == "ticks":
        return df.withColumns({
            "event_ts": epoch_ms_to_ts("event_time"),
            "trade_notional": F.col("price") * F.col("volume"),
        })
    if feed == "behavior":
        columns = schemas.feed_schema("behavior").names
        return df.select(*columns, F.col("timestamp").alias("event_time"))
    raise ValueError(f"unknown feed {feed!r}")


def require_columns(df: DataFrame, feed: str) -> DataFrame:
    """Fail the job on a NULL in a column the feed declares as always present."""
    def checked(name: str) -> Column:
        message = F.lit(f"{feed}.{name} must not be NULL")
        return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))

    return df.withColumns({name: checked(name) for name in schemas.REQUIRED.get(feed, ())})
