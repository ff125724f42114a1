from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import ODD, SCHEMA, clashing, documents, prose
from tidemark.llm import near_dedup
from tidemark.llm.components import components


def word_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_force(rows, size, percent):
    """Smallest id reachable from each row, over all pairs."""
    sets = [word_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    least = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    return Counter((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def changed(text, seed, share):
    """``text`` with a share of its words replaced."""
    rng, words = random.Random(seed), text.split()
    for i in rng.sample(range(len(words)), int(len(words) * share)):
        words[i] = f"w{seed}{i}"
    return " ".join(words)


def family_rows():
    rows = list(ODD)
    for f in range(12):
        base = prose(100 + f, 60 + 20 * f)
        rows.append((1000 + 100 * f, base))
        for c in range(10):
            rows.append((1000 + 100 * f + c + 1, changed(base, f * 100 + c, 0.012 * c)))
    chain = prose(5, 200)  # each link is close, its ends are not
    for c in range(8):
        rows.append((5000 - c, chain))
        chain = changed(chain, 900 + c, 0.02)
    return rows


@pytest.mark.parametrize("size, percent, block", [(3, 85, 128), (5, 80, 4)])
def test_components(spark, monkeypatch, size, percent, block):
    """Small blocks make every bucket and cluster a large one."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = family_rows()
    found = near_dedup.near_duplicates(clashing(documents(spark, rows)), size, percent)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == brute_force(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_one_row_per_component_stays(spark):
    rows = [*ODD, (20, "a b c d e f g h"), (19, "a b c d e f g h"), (19, "other words")]
    docs = clashing(documents(spark, rows))
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got[(19, "a b c d e f g h")] == got[(19, "other words")] == 1
    assert {i for i, _ in got} == {1, None, 4, 5, 6, -3, 8, 9, 10, 19}
    assert got[(-3, "one")] == 1 and (20, "a b c d e f g h") not in got


def test_no_documents(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    b = np.concatenate([a[:1500], rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    x, y = (near_dedup.signature(np.unique(s), 400) for s in (a, b))
    assert abs((x == y).mean() - 0.6) < 0.08


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a int, b int"))
    assert dict(map(tuple, found.collect())) == {
        **{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
