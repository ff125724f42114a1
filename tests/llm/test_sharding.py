from __future__ import annotations

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, SCHEMA, clashing, documents
from tidemark.llm import sharding

TREE = sharding.balanced(2, 2, 4)


def brute(tree, key):
    """Descent by plain Python."""
    def weight(node):
        return sum(map(weight, node.values())) if isinstance(node, dict) else node

    def drawn(path, node):
        digest = hashlib.md5(f"53:{'null' if key is None else key}{path}".encode()).hexdigest()
        return -math.log((int(digest[:13], 16) + 0.5) / 2.0 ** 52) / weight(node)

    path, node = "", tree
    while isinstance(node, dict):
        name = min((n for n in node if weight(node[n])),
                   key=lambda n: (drawn(f"{path}/{n}", node[n]), str(n)))
        path, node = f"{path}/{name}", node[name]
    return int(path.rsplit("/", 1)[1])


def places(spark, tree, count):
    ids = spark.range(count).withColumn("shard", sharding.shard_of(tree, F.col("id")))
    return {r.id: r.shard for r in ids.collect()}


UNEVEN = {"a": {"x": {0: 1, 1: 2}, "y": {2: 3.5}}, "b": {"x": {3: 0, 4: 1}, "z": {5: 0}},
          "c": {"w": {6: 0}}}


@pytest.mark.parametrize("tree", [TREE, sharding.grown(TREE), UNEVEN])
def test_descent_is_that_of_plain_python(spark, tree):
    found = places(spark, tree, 500)
    assert found == {i: brute(tree, i) for i in range(500)}


def test_shares_follow_the_weights(spark):
    found = list(places(spark, UNEVEN, 20_000).values())
    total = 1 + 2 + 3.5 + 1
    for shard, weight in {0: 1, 1: 2, 2: 3.5, 3: 0, 4: 1, 5: 0, 6: 0}.items():
        assert abs(found.count(shard) / 20_000 - weight / total) < 0.015


def test_a_new_shard_takes_rows_only_into_itself(spark):
    tree = TREE
    for _ in range(3):
        before, tree = places(spark, tree, 8000), sharding.grown(tree)
        after = places(spark, tree, 8000)
        moved = {after[i] for i in after if after[i] != before[i]}
        assert moved == {max(after.values())}
        share = sum(after[i] != before[i] for i in after) / 8000
        assert abs(share - 1 / len(set(after.values()))) < 0.02


def test_a_changed_weight_moves_rows_only_by_its_subtrees(spark):
    changed = {g: {r: dict(s) for r, s in racks.items()} for g, racks in TREE.items()}
    changed["region1"]["rack0"][9] = 4.0
    before, after = places(spark, TREE, 20_000), places(spark, changed, 20_000)
    for i, old in before.items():
        new = after[i]
        if new == old:
            continue
        assert new // 8 == 1                       # into the heavier region
        if old // 8 == 1:
            assert new // 4 == 2                   # within it, into the heavier rack
        if old // 4 == 2:
            assert new == 9                        # within that, into the heavier shard
    assert any(after[i] != before[i] for i in before)


def test_written_shards(spark, tmp_path):
    rows = [*ODD, *((100 + i, "text " * (i % 50)) for i in range(300)),
            *((7, f"copy {i % 3}") for i in range(200))]
    docs = clashing(documents(spark, rows)).withColumn("a.b", F.map_from_arrays(
        F.array(F.lit("k")), F.array("doc_id"))).repartition(3)
    found = sharding.written(docs, TREE, str(tmp_path / "shards"))
    assert found.select("row.*").columns == docs.columns
    got = found.collect()
    assert len(got) == len(rows)
    by_shard: dict = {}
    for r in got:
        assert r.shard == brute(TREE, r.row.doc_id)
        by_shard.setdefault(r.shard, {})[r.slot] = r.row
    for shard, slots in by_shard.items():
        assert sorted(slots) == list(range(len(slots)))
        keys = [(slots[i].doc_id is None, slots[i].doc_id or 0, len((slots[i].text or "").encode()),
                 zlib.crc32((slots[i].text or "").encode())) for i in range(len(slots))]
        assert keys == sorted(keys)
        folder = spark.read.parquet(str(tmp_path / "shards" / f"shard={shard}"))
        assert folder.count() == len(slots)


def test_digests_and_odd_documents(spark):
    got = sharding.digested(clashing(documents(spark, ODD)), TREE).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()),
                   brute(TREE, i), brute(sharding.grown(TREE), i)) for i, t in ODD)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard)
                  for r in got) == want
    empty = sharding.digested(spark.createDataFrame([], SCHEMA), TREE)
    assert empty.collect() == []


def test_a_tree_needs_weight():
    for tree in ({}, {"a": {"b": {1: 0}}}, {"a": {"b": {1: -1}}}):
        with pytest.raises(ValueError):
            sharding.children(tree)
