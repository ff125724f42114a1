"""Importance resampling towards the distribution of target texts.

Features are all runs of one to three neighbouring words; each falls into one of ``BUCKETS``
buckets by its checksum. Bucket counts of all documents and of all target texts give every
bucket a gain, the floored log ratio (times 1000) of the two smoothed shares. A document's
weight is the sum of its features' gains, taken from the array of gains. A Gumbel number,
which a hash of the id makes, turns the weights into a draw without replacement: the highest
sums of both win.

1. Bucket counts: one array per task, merged by bucket. 10,000 rows reach the driver.
2. Weights and scores are stored, a narrow row per document.
3. The score of the last row drawn is found by bisection: each round halves the interval
   between two scores by an exact count of the rows above its middle. Where rows tie on
   that score, the same bisection over their ids finds the last id drawn.
4. The rows at or above that cut-off are dealt out by ranges of score and id, which numbers
   them. Rows with the same score and id, if more of them lie on the cut-off than are to be
   drawn, are told apart by their number of features, and taken from equals as they come.

Words are found, and their checksums computed, over the bytes of many texts at once. The CRC-32
of two strings in a row follows from those of its parts, by tables that move the first one over
the length of the second; so runs of words cost no pass over their bytes.

Defined cases: a null or empty text, or one without words, has no features and weight 0;
texts below ``least_words`` words are never drawn; rows that repeat an id are documents of
their own, with one Gumbel number; a null id counts as the text ``null`` and comes after all
others. Without target texts all gains compare with equal shares. Ids that are not whole
numbers skip the second bisection: all rows that tie are numbered. Other columns never
matter. An empty table gives an empty draw.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm.common import numbered, stored

BUCKETS = 10_000
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SHORT = 64          # bytes of a word; longer ones are taken one by one
FLUSH = 4 << 20     # bytes of text a task works on at once, or one text

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)  # A-Z only
# Digits, a-z and every byte of a character beyond ASCII, after lower-casing.
IN_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (
    _BYTES >= 0x80)
_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32 as zlib and SQL have it


def over_zeros(crcs: np.ndarray, count: int) -> np.ndarray:
    """Raw checksums moved on over ``count`` zero bytes, one byte at a time."""
    table = byte_table()
    for _ in range(count):
        crcs = table[crcs & np.uint32(255)] ^ crcs >> np.uint32(8)
    return crcs


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    found = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        found = np.where(found & np.uint32(1), found >> np.uint32(1) ^ np.uint32(_POLYNOMIAL),
                         found >> np.uint32(1))
    return found


@lru_cache(maxsize=1)
def move_tables() -> np.ndarray:
    """``[count, byte, value]``: a value in a byte of a checksum, over ``count`` zero bytes."""
    start = np.arange(256, dtype=np.uint32)[None] << np.array([[0], [8], [16], [24]], np.uint32)
    found = [start]
    for _ in range(SHORT):
        found.append(over_zeros(found[-1], 1))
    return np.stack(found)


def followed(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of strings joined in pairs, from both parts' and the second's length."""
    tables, short = move_tables(), np.minimum(lengths, SHORT)
    moved = np.zeros(len(first), np.uint32)
    for byte in range(4):
        moved ^= tables[short, byte, first >> np.uint32(8 * byte) & np.uint32(255)]
    for i in np.flatnonzero(lengths > SHORT):
        moved[i] = over_zeros(moved[i:i + 1], int(lengths[i]) - SHORT)[0]
    return moved ^ second


def word_checksums(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, all words one byte further in each step, the longest first."""
    order = np.argsort(-np.minimum(lengths, SHORT).astype(np.int16), kind="stable")
    table, starts, sizes = byte_table(), begins[order], lengths[order]
    crcs = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for i in range(min(int(lengths.max(initial=0)), SHORT)):
        many = np.searchsorted(-sizes, -i, "left")  # words of more than i bytes
        now = crcs[:many]
        crcs[:many] = table[(now ^ data[starts[:many] + i]) & np.uint32(255)] ^ now >> np.uint32(8)
    found = np.empty_like(crcs)
    found[order] = ~crcs
    for i in np.flatnonzero(lengths > SHORT):
        found[i] = zlib.crc32(data[begins[i]:begins[i] + lengths[i]].tobytes())
    return found


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and for every feature its text and its bucket."""
    data = LOWER[np.frombuffer(b"\0".join([*(t or b"" for t in texts), b""]), np.uint8)]
    inside = np.concatenate([[False], IN_WORD[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # the last byte is outside
    begins, lengths = edges[::2], edges[1::2] - edges[::2]
    limits = np.cumsum([len(t or b"") + 1 for t in texts])
    text_of = np.searchsorted(limits, begins, "right")
    counts = np.bincount(text_of, minlength=len(texts))
    last = np.repeat(np.cumsum(counts), counts)  # end of the word's text
    alone = word_checksums(data, begins, lengths)
    blank = np.full(len(alone), zlib.crc32(b" "), np.uint32)
    behind = followed(blank, alone, lengths)
    places, crcs = np.arange(len(alone)), alone
    texts_of, buckets = [text_of], [alone % np.uint32(BUCKETS)]
    for size in range(1, RUN):
        keep = places + size < last[places]
        places, crcs = places[keep], crcs[keep]
        crcs = followed(crcs, behind[places + size], lengths[places + size] + 1)
        texts_of.append(text_of[places])
        buckets.append(crcs % np.uint32(BUCKETS))
    return counts, np.concatenate(texts_of), np.concatenate(buckets).astype(np.int64)


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes | None]]]:
    """Texts of a batch as bytes, a few at a time, with the place of the first one."""
    texts = batch.column(column).cast(pa.binary())
    begin = size = 0
    for i in range(len(texts)):
        size += len(texts[i].as_py() or b"")
        if size >= FLUSH or i + 1 == len(texts):
            yield begin, texts.slice(begin, i + 1 - begin).to_pylist()
            begin, size = i + 1, 0


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of a table's texts per bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, some in pieces(batch, 0):
                total += np.bincount(features(some)[2], minlength=BUCKETS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    counts = texts.select("text").mapInArrow(count, "bucket int, n bigint")
    found = np.zeros(BUCKETS, np.int64)
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():
        found[bucket] = n
    return found


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored log ratios of the smoothed shares, times 1000, per bucket."""
    above = (target + 1).astype(float) * float(raw.sum() + BUCKETS)
    below = (raw + 1).astype(float) * float(target.sum() + BUCKETS)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A floored Gumbel number, times 1000, from the document's id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((bits + 0.5) / F.lit(4294967296.0))))


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, some in pieces(batch, 1):
                counts, text_of, buckets = features(some)
                number = np.bincount(text_of, minlength=len(some))
                # Sums stay far below 2**53, so doubles hold them exactly.
                weight = np.bincount(text_of, gain[buckets], len(some)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(some)), pa.array(counts),
                     pa.array(number.astype(np.int64)), pa.array(weight)],
                    ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", "text").mapInArrow(
        weigh, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")
    return rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def bisected(rows: DataFrame, column: str, k: int, largest: bool) -> int | None:
    """The ``k``-th value from the largest (or smallest) on, over rows where it is known.

    Every round counts the rows on one side of the middle; ``None`` for less than ``k``.
    """
    low, high, known = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if known < k:
        return None
    while low < high:
        if largest:
            middle = (low + high + 1) // 2
            if rows.where(F.col(column) >= middle).count() >= k:
                low = middle
            else:
                high = middle - 1
        else:
            middle = (low + high) // 2
            if rows.where(F.col(column) <= middle).count() >= k:
                high = middle
            else:
                low = middle + 1
    return low


def drawn(rows: DataFrame, k: int) -> DataFrame:
    """Stored rows of ``scored`` with ``rank``: 1 .. k for those drawn, else null.

    ``rows`` with a false ``eligible`` are never drawn.
    """
    none = F.lit(None).cast("bigint").alias("rank")
    may = rows.where("eligible")
    cut = bisected(may, "score", k, largest=True) if k > 0 else None
    if cut is None:
        if k > 0:  # fewer rows than are to be drawn: all of them
            inside = F.col("eligible")
        else:
            return rows.select("*", none)
    else:
        inside = F.col("eligible") & (F.col("score") >= cut)
        tied = may.where(F.col("score") == cut)
        left = k - may.where(F.col("score") > cut).count()
        if isinstance(rows.schema["doc_id"].dataType, IntegralType):
            last = bisected(tied, "doc_id", left, largest=False)
            if last is not None:
                inside &= (F.col("score") > cut) | (F.col("doc_id") <= last)
    chosen = rows.where(inside).withColumn("spread", F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"),
             F.col("spread")]
    ranked = numbered(chosen, order, "place").withColumn(
        "rank", F.when(F.col("place") < k, F.col("place").cast("bigint") + 1))
    rest = rows.where(~F.coalesce(inside, F.lit(False)))
    return ranked.select(*rows.columns, "rank").unionAll(rest.select(*rows.columns, none))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT,
              least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row of ``docs``.

    ``percent`` of the documents with ``least_words`` words are drawn.
    """
    rows = stored(scored(docs, target, seed).select(
        "doc_id", (F.col("n_words") >= least_words).alias("eligible"), "n_features", "weight",
        "score"))
    k = percent * rows.where("eligible").count() // 100
    return drawn(rows, k).select("doc_id", "n_features", "weight", "score", "rank")
