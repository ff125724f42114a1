from __future__ import annotations

from collections import Counter

import pytest

from tests.llm.helpers import ODD, SCHEMA, clashing, documents
from tidemark.llm import mixing


def filled(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing out what is left, round after round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    full: dict = {}
    while True:
        left = sum(sizes.values()) - sum(full.values())
        share = sum(w for s, w in weight.items() if s not in full) or 1
        fair = {s: left * w / share for s, w in weight.items() if s not in full}
        above = [s for s, t in fair.items() if t > cap * sizes[s]]
        if not above:
            return full | fair
        full |= {s: cap * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 2, "d": 3, None: 50},
    {"é": 10, "z": 0, "Z": 5, "": 7}, {"a": 0, "b": 0}, {"only": 5},
])
def test_targets(spark, sizes):
    found = mixing.targets(spark.createDataFrame(
        list(sizes.items()), "source string, source_size bigint"))
    got = {r.source: r.target for r in found.collect()}
    assert got == pytest.approx(filled(sizes))


def test_documents_are_drawn_by_rate(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(600)]
    rows += [(1000 + i, "v " * 10, None) for i in range(20)]
    docs = clashing(documents(spark, rows))
    drawn = {r.row.doc_id: r for r in mixing.copies(docs).collect()}
    for source in ("a", "b", None):
        of = [r for r in drawn.values() if r.row.source == source]
        assert abs(sum(r.size * r.copies for r in of) / of[0].target - 1) < 0.1
        assert all(0 <= r.copies <= 3 for r in of)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == {
        i: r.copies for i, r in drawn.items() if r.copies}


def test_odd_documents(spark):
    first, again = (sorted(map(repr, mixing.copies(documents(spark, ODD)).collect()))
                    for _ in range(2))
    assert first == again and len(first) == len(ODD)
    assert mixing.copies(documents(spark, [(1, None, "a"), (2, " ", "a")])).select(
        "copies").distinct().collect() == [(1,)]
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
