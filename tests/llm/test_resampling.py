from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import ODD, SCHEMA, clashing, documents, prose
from tidemark.llm import resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    words = WORD.findall((text or "").encode().lower())
    return len(words), [zlib.crc32(b" ".join(words[i:i + n])) % 10000 for n in (1, 2, 3)
                        for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5, least=20):
    raw, wanted = Counter(), Counter()
    for _, text in rows:
        raw.update(runs(text)[1])
    for text in target:
        wanted.update(runs(text)[1])
    big, small = sum(raw.values()), sum(wanted.values())
    found = []
    for doc_id, text in rows:
        n, features = runs(text)
        weight = sum(math.floor(1000 * math.log(
            ((wanted[b] + 1) * (big + 10000)) / ((raw[b] + 1) * (small + 10000))))
            for b in features)
        name = "null" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(features), weight, score, None, n >= least])
    may = [r for r in found if r[5]]
    may.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(may[:percent * len(may) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in found), key=repr)


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_features_of_odd_texts():
    texts = [t for _, t in ODD] + ["The quick  brown FOX, jumps!", "ÀÉ é", "x" * 63 + " " + "y" * 64
             + " " + "z" * 65 + " a " + "w" * 200, "a\u0000b", "1 2 3", "日本 語"]
    raw = [None if t is None else t.encode() for t in texts]
    counts, of, buckets = resampling.features(raw)
    want = [runs(t) for t in texts]
    assert counts.tolist() == [n for n, _ in want]
    assert sorted(zip(of.tolist(), buckets.tolist())) == sorted(
        (i, b) for i, (_, found) in enumerate(want) for b in found)
    assert len(resampling.features([])[1]) == 0


ROWS = [*ODD, *((100 + i, prose(i, 15 + i % 30)) for i in range(300)),
        *((i % 5, prose(7, 40)) for i in range(150)), *((None, prose(7, 40)) for _ in range(40))]
TARGET = [prose(i, 30) for i in range(0, 60, 3)] + [None, ""]


@pytest.mark.parametrize("percent", [0, 5, 62, 100])
def test_draw_against_plain_python(spark, percent):
    docs = clashing(documents(spark, ROWS)).repartition(3)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = resampling.resampled(docs, target, percent).collect()
    assert ordered(got) == brute(ROWS, TARGET, percent)


def test_any_share_of_tied_rows(spark):
    """Rows that tie on the cut-off: by their ids, then as they come."""
    rows = spark.createDataFrame(
        [(i % 4, True, 9, s) for i in range(40) for s in (1, 2)]
        + [(None, True, 9, 2)] * 5 + [(1, False, 9, 3)] * 7,
        "doc_id bigint, eligible boolean, n_features bigint, score bigint").repartition(4)
    order = sorted(((-r.score, r.doc_id is None, r.doc_id or 0) for r in rows.collect()
                    if r.eligible))
    for k in (0, 11, 40, 43, 46, 90):
        found = resampling.drawn(rows, k).collect()
        assert len(found) == 92
        ranked = sorted((r for r in found if r.rank is not None), key=lambda r: r.rank)
        assert [r.rank for r in ranked] == list(range(1, min(k, 85) + 1))
        assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in ranked] == order[:k]


def test_bisection_counts(spark):
    values = spark.createDataFrame([(v,) for v in [5, -3, 5, 1 << 40, -(1 << 40), 0, None]],
                                   "v bigint")
    known = sorted([5, -3, 5, 1 << 40, -(1 << 40), 0])
    for k in range(1, 7):
        assert resampling.bisected(values, "v", k, largest=True) == known[-k]
        assert resampling.bisected(values, "v", k, largest=False) == known[k - 1]
    assert resampling.bisected(values, "v", 7, largest=True) is None


def test_drawn_documents_are_nearer_to_the_target(spark):
    target = [f"alpha beta gamma delta {i}" for i in range(200)]
    rows = [(i, " ".join(["alpha beta gamma delta"] * 6) if i % 20 == 0 else prose(i, 24))
            for i in range(400)]
    found = resampling.resampled(documents(spark, rows), spark.createDataFrame(
        [(t,) for t in target], "text string")).where("rank is not null")
    assert [r.doc_id % 20 for r in found.collect()] == [0] * 20


def test_string_ids_and_empty_tables(spark):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    named = spark.createDataFrame([(f"d{i:03}", prose(i, 25)) for i in range(100)],
                                  "doc_id string, text string")
    ranks = resampling.resampled(named, target).where("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == [1, 2, 3, 4, 5]
    assert [r.score for r in ranks] == sorted((r.score for r in ranks), reverse=True)
    assert resampling.resampled(spark.createDataFrame([], SCHEMA), target).collect() == []
    none = resampling.resampled(documents(spark, ROWS), target.where("false")).collect()
    assert ordered(none) == brute(ROWS, [])


def test_gains_of_equal_shares_are_nought():
    assert (resampling.gains(np.ones(10000), np.ones(10000)) == 0).all()
