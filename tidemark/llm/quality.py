"""Importance resampling of documents towards good text.

Two bag models over hashed n-grams (words and pairs of neighbours): one of the target, the
documents labelled good, and one of all raw documents. A document's log weight is the mean
log ratio of the two models over its n-grams. Gumbel noise on the weights and the k highest
sums draw k documents without replacement, by their weight; the noise is a hash of the id,
so every run draws the same.

- The target model is fitted on at most ``TARGETS`` labelled documents, those with the
  smallest hashed ids. The raw model counts every n-gram of every document.
- Buckets with little evidence pull to ratio 1 (``PRIOR`` pseudo-counts), and so do short
  documents (``SHORT`` n-grams of ratio 1).
- The weight's exponent is ``SCALE`` n-grams, for all documents alike. An exponent of the
  document's own length would let long documents win or lose by length alone.
- k is a share of the rows, given by the caller, or else the size of the target within the raw
  text: the expected number of good documents. A logistic regression of the label on the log
  weight, fitted on at most ``TARGETS`` labelled documents, gives each document's probability;
  k is their sum over all documents.

Defined cases: null, empty and white-space texts have no n-grams and weight 1; without labels
of both qualities the target's size is unknown and, unless a share is given, every document is
drawn; without any label of good quality all weights are 1; an id with several labels is good
if one of them is; rows that tie with the last one drawn are all drawn; rows that repeat a
``doc_id`` share their noise. Other columns never matter to the draw and pass through. An empty
table gives an empty draw.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BUCKETS = 10_000
TARGETS = 20_000
PRIOR = 10
SHORT = 20
SCALE = 100
RIDGE = 1e-3      # keeps the slope finite where one weight tells all labels apart
SEED = 29
REMEMBERED = 400_000

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
_AGAIN = np.uint64(0x5851F42D4C957F2D)  # a word and itself, whatever the word


class Hashes(dict):
    def __missing__(self, token: str) -> int:
        from xxhash import xxh3_64_intdigest

        found = xxh3_64_intdigest(token)
        if len(self) < REMEMBERED:
            self[token] = found
        return found


def ngram_buckets(text: str | None, hashes: Hashes) -> np.ndarray:
    """Buckets of a text's words and pairs; a word after itself is one kind of pair."""
    tokens = _TOKEN.findall((text or "").lower())
    words = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    pairs = words[:-1] * _A ^ words[1:] * _B
    pairs[words[:-1] == words[1:]] = _AGAIN
    found = np.concatenate([words, pairs])
    found ^= found >> np.uint64(29)
    found *= _C
    found ^= found >> np.uint64(32)
    return (found % np.uint64(BUCKETS)).astype(np.int64)


def log_ratios(docs: DataFrame, labels: DataFrame, targets: int = TARGETS) -> np.ndarray:
    """Log ratio of the target to the raw model, per bucket: all that reaches the driver."""
    good = (
        labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("good_id")).distinct()
        .orderBy(F.xxhash64("good_id"), "good_id").limit(targets)
    )
    flagged = docs.select("doc_id", "text").join(
        F.broadcast(good), F.col("doc_id") == F.col("good_id"), "left"
    ).select("text", F.col("good_id").isNotNull().alias("is_target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, raw, target = Hashes(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, is_target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.bincount(ngram_buckets(text, hashes), minlength=BUCKETS)
                raw += found
                if is_target:
                    target += found
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(raw), pa.array(target)],
            ["bucket", "raw", "target"])

    counts = flagged.mapInArrow(count, "bucket int, raw bigint, target bigint")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[row[0]], target[row[0]] = row[1], row[2]
    expected = raw * (target.sum() / max(raw.sum(), 1))
    return np.log((target + PRIOR) / (expected + PRIOR))


def scored(docs: DataFrame, labels: DataFrame, targets: int = TARGETS,
           seed: int = SEED) -> DataFrame:
    """``docs`` in a column ``row``, with ``id``, ``log_weight`` (per n-gram) and ``score``."""
    ratios = log_ratios(docs, labels, targets)

    @F.pandas_udf("double")
    def weight(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = Hashes()
        for texts in batches:
            found = (ratios[ngram_buckets(t if isinstance(t, str) else "", hashes)] for t in texts)
            yield pd.Series([r.sum() / (len(r) + SHORT) for r in found], dtype="float64")

    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"),
                       weight("text").alias("log_weight"),
                       gumbel(F.lit(seed), F.col("doc_id")).alias("noise"))
    return rows.select("row", "id", "log_weight", score().alias("score"))


def gumbel(seed: Column, doc_id: Column) -> Column:
    """Standard Gumbel noise, a hash of the seed and the id."""
    key = F.concat(seed.cast("string"), F.lit(":"),
                   F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(2.0 ** 52)))


def score() -> Column:
    return F.col("log_weight") * SCALE + F.col("noise")


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, exactly: histograms of at most 1024 bins, ever narrower."""
    value = F.col(column)
    low, high, above = *rows.agg(F.min(column), F.max(column)).first(), 0
    while low < high:
        width = (high - low) / 1024
        place = F.least(F.floor((value - low) / width), F.lit(1023))
        bins = (rows.where(value.between(low, high)).groupBy(place.alias("bin"))
                .agg(F.count("*"), F.min(column), F.max(column)).collect())
        for _, count, least, most in sorted(bins, reverse=True):
            if above + count >= k:
                low, high = least, most
                break
            above += count
    return low


def logistic(weights: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the label's log odds, by Newton's method."""
    columns = np.column_stack([weights, np.ones(len(weights))])
    ridge, found = np.diag([RIDGE, 0.0]), np.zeros(2)

    def loss(at: np.ndarray) -> float:
        odds = columns @ at
        return np.logaddexp(0, odds).sum() - odds @ good + at @ ridge @ at / 2

    for _ in range(100):
        chance = 0.5 * (1 + np.tanh(columns @ found / 2))
        slope = columns.T @ (chance - good) + ridge @ found
        bend = (columns * (chance * (1 - chance))[:, None]).T @ columns + ridge
        step = np.linalg.solve(bend + 1e-12 * np.eye(2), slope)
        size = 1.0
        while loss(found - size * step) > loss(found) and size > 1e-9:
            size /= 2
        found = found - size * step
        if np.abs(size * step).max() < 1e-9 * (1 + np.abs(found).max()):
            break
    return found[0], found[1]


def target_size(rows: DataFrame, labels: DataFrame, targets: int = TARGETS) -> int:
    """Expected number of good documents among stored rows of ``scored``."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").alias("labelled")).agg(F.max(F.col("quality") == 1).alias("good"))
    order = [F.xxhash64("labelled"), "labelled"]
    sample = known.orderBy(*order).limit(targets)
    found = rows.join(F.broadcast(sample), F.col("id") == F.col("labelled")).select(
        *order, "log_weight", "good").orderBy(*order, "log_weight").limit(2 * targets).collect()
    good = np.array([r.good for r in found], float)
    if not len(good) or good.min() == good.max():
        return rows.count()
    a, b = logistic(np.array([r.log_weight for r in found]), good)
    chance = 1 / (1 + F.exp(-(F.col("log_weight") * float(a) + float(b))))
    millionths = F.round(chance * 1e6).cast("bigint")  # sums of doubles depend on their order
    return round((rows.agg(F.sum(millionths)).first()[0] or 0) / 1e6)


def drawn(rows: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """Stored rows of ``scored`` with the column ``selected``: ``share`` of them, or as many as
    the target is estimated to have."""
    k = target_size(rows, labels) if share is None else round(share * rows.count())
    least = kth_largest(rows, "score", k) if k else float("inf")
    return rows.withColumn("selected", F.col("score") >= least)
