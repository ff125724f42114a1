"""Concatenate and cut: all documents' ids as one stream, cut into fixed windows.

1. Each task encodes its documents once and stores the ids with their place in the task's
   own stream.
2. Prefix sums over the tasks' totals (one row per task) turn places into global offsets,
   and each document is cut where its range crosses a window's end. Pieces on a border fall
   into both windows' records; only the very last window is short.

The stored ids hold the numbers of the tasks that wrote them, so a lost executor or a task
that ran twice can't shift any offset.

Defined cases: a null text is empty, and an empty document is its end id alone. Rows that
repeat a ``doc_id`` are documents of their own. A very long document spans many windows.
Other columns never matter. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.tokens import encoder

WINDOW = 2048
END_ID = 1
FLUSH = 4 << 20  # bytes of ids per batch that leaves a task


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, part, place, doc_tokens, ids)``: ids as little-endian 32-bit integers."""
    kind = docs.schema["doc_id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        part, place, names = TaskContext.get().partitionId(), 0, None
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            keys, places, counts, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, names), pa.array([part] * len(rows), pa.int32()),
                 pa.array(places, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.binary())],
                ["doc_id", "part", "place", "doc_tokens", "ids"])

        for taken in batches:
            names = taken.schema.field(0).type
            for doc_id, text in zip(taken.column(0).to_pylist(), taken.column(1).to_pylist()):
                ids = ids_of(text) + end
                rows.append((doc_id, place, len(ids) // 4, ids))
                place += len(ids) // 4
                size += len(ids)
                if size >= FLUSH:
                    yield batch()
                    rows.clear()
                    size = 0
        if rows:
            yield batch()

    schema = (f"doc_id {kind.simpleString()}, part int, place bigint, doc_tokens bigint, "
              "ids binary")
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW,
           end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document, with its ids and its place in a window."""
    parts = stored(encoded(docs, tokenizer, end_id), compression="zstd")
    totals = parts.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    starts = stored(totals.select("part", before.alias("before")))  # a row per first-pass task

    size = F.lit(window)
    begin = F.col("before") + F.col("place")

    def piece(n):
        first = F.greatest(n * size, F.col("begin"))
        last = F.least((n + 1) * size, F.col("begin") + F.col("doc_tokens"))
        start = first - F.col("begin")
        return F.struct(
            start.alias("start"), (last - first).alias("length"),
            F.substring(F.col("ids"), (start * 4 + 1).cast("int"),
                        ((last - first) * 4).cast("int")).alias("ids"),
            n.alias("sequence_id"), (first - n * size).alias("offset"))

    windows = F.sequence(F.floor(F.col("begin") / size),
                         F.floor((F.col("begin") + F.col("doc_tokens") - 1) / size))
    return (
        parts.join(starts, "part")
        .select("doc_id", "doc_tokens", "ids", begin.alias("begin"))
        .select("doc_id", "doc_tokens", F.explode(F.transform(windows, piece)).alias("piece"))
        .select("doc_id", "piece.start", "piece.length", "piece.ids", "doc_tokens",
                "piece.sequence_id", "piece.offset")
    )


def with_checksums(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
