"""The whole pipeline against plain Python, on a small folder of tables."""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import ODD, SCHEMA, clashing, documents, prose
from tests.llm.test_mixing import filled
from tests.llm.test_near_dedup import changed, word_set
from tests.llm.test_tokens import check_pieces
from tidemark.llm import common, mixing, quality
from tidemark.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def uniform(seed, doc_id):
    key = f"{seed}:{'null' if doc_id is None else doc_id}"
    return int(hashlib.sha256(key.encode()).hexdigest()[:13], 16)


def good(rows, good_ids, bad_ids):
    hashes, raw, target = quality.Hashes(), np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    found = [quality.ngram_buckets(r[1], hashes) for r in rows]
    for row, buckets in zip(rows, found):
        counts = np.bincount(buckets, minlength=quality.BUCKETS)
        raw += counts
        target += counts * (row[0] in good_ids)
    expected = raw * target.sum() / raw.sum()
    ratios = np.log((target + quality.PRIOR) / (expected + quality.PRIOR))
    weights = [ratios[b].sum() / (len(b) + quality.SHORT) for b in found]
    scores = [w * quality.SCALE - math.log(-math.log((uniform(quality.SEED, r[0]) + 0.5) / 2 ** 52))
              for r, w in zip(rows, weights)]
    known = [(w, r[0] in good_ids) for r, w in zip(rows, weights) if r[0] in good_ids | bad_ids]
    slope, start = quality.logistic(*(np.array(x, float) for x in zip(*known)))
    k = round(sum(round(1e6 / (1 + math.exp(-slope * w - start))) for w in weights) / 1e6)
    least = sorted(scores, reverse=True)[k - 1]
    return [r for r, s in zip(rows, scores) if s >= least]


def order(row):
    return row[0] is None, row[0] or 0


def one_per_text(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row)
    return [min(g, key=order) for g in groups.values()]


def one_per_component(rows):
    sets = [word_set(r[1], 5) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    members = defaultdict(list)
    for row, g in zip(rows, group):
        members[g].append(row)
    return [min(m, key=order) for m in members.values()]


def mixed(rows):
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[2]] += len(WORD.findall(row[1] or ""))
    targets = filled(sizes)
    found = []
    for row in rows:
        rate = targets[row[2]] / sizes[row[2]] if sizes[row[2]] else 1
        coin = uniform(mixing.SEED, row[0]) / 2 ** 52
        found += [row] * min(3, math.floor(rate) + (coin < rate - math.floor(rate)))
    return found


def test_pipeline(spark, tmp_path):
    rows = [(r[0], r[1], f"src{(r[0] or 0) % 4}") for r in ODD if r[0] != 7]
    for i in range(40):
        base = prose(i, 50 + 5 * i)
        rows.append((100 + i, base, f"src{i % 5}"))
        if i % 4 == 0:
            rows.append((200 + i, base.replace(" ", "  "), f"src{i % 3}"))
            rows.append((300 + i, changed(base, i, 0.02), "src9"))
    rows += [(400 + i, "buy!!! now!!! " * 30, "src1") for i in range(5)]
    good_ids, bad_ids = set(range(100, 130)), {400, 401, 402}
    clashing(documents(spark, rows)).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in good_ids] + [(i, 0, 0) for i in bad_ids]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    want, docs = rows, spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = [lambda r: good(r, good_ids, bad_ids), one_per_text, one_per_component, mixed]
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        columns = docs.columns
        docs, want = stored(stage(spark, docs, str(tmp_path))), step(want)
        assert docs.columns == columns
        got = sorted(((r.doc_id, r.text, r.source) for r in docs.collect()), key=repr)
        assert got == sorted(want, key=repr), name
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_pieces(list(map(tuple, pieces)), [r[:2] for r in want], 2048)


def test_finished_stages_leave_no_scratch(spark, tmp_path, monkeypatch):
    rows = [(i, prose(i, 40), f"src{i % 3}") for i in range(60)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int"
                          ).write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(common, "scratch_dir",
                        lambda _: str(tmp_path / "scratch" / uuid.uuid4().hex))
    (tmp_path / "scratch").mkdir()

    def folders():
        return {p.name for p in (tmp_path / "scratch").iterdir()}

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, apply) in enumerate(corpus_pipeline.STAGES):
        before = folders()
        result = apply(spark, docs, str(tmp_path))
        assert not folders() & before  # what came before is gone, this stage's own is there
        result.write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_scratch_that_documents_are_read_from_stays(spark, tmp_path):
    rows = [(i, prose(i, 40), "a") for i in range(20)] + [(50, prose(1, 40), "a")]
    first = corpus_pipeline.exact_duplicates(spark, documents(spark, rows), "")
    near = corpus_pipeline.near_duplicates(spark, first, "")
    with common.collecting(corpus_pipeline._KEPT):
        docs = stored(near)
    assert corpus_pipeline.mix(spark, docs, "").count() == 20 and docs.count() == 20


def test_stages_take_maps_and_any_names(spark):
    rows = [*ODD, (7, "one"), (7, "one"), (40, prose(8, 4000))]
    docs = clashing(documents(spark, rows)).withColumns({
        "a.b": F.col("doc_id"), "m": F.create_map(F.lit("k"), "doc_id"), "x`y": F.lit(1)})
    for apply in (corpus_pipeline.exact_duplicates, corpus_pipeline.near_duplicates,
                  corpus_pipeline.mix):
        found = apply(spark, docs, "")
        assert found.columns == docs.columns
        assert all(r["a.b"] == r.doc_id and r.m["k"] == r.doc_id for r in found.collect())
    seven = docs.where("doc_id = 7")  # four rows alike
    assert corpus_pipeline.exact_duplicates(spark, seven, "").count() == 1
    assert corpus_pipeline.near_duplicates(spark, seven, "").count() == 1


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
