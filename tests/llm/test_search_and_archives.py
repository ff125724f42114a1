from __future__ import annotations

import base64
import hashlib
import shutil
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.llm import ann, files, warc
from tidemark.llm.queries import op6_multiprobe_search

VECTORS = "vec_id bigint, embedding array<float>, label int"


def ranked(vectors, query_id, k):
    """Exact answer: (vec_id, score), ties to the smaller id."""
    query = np.array(vectors[query_id], np.float32).astype(float)
    scores = [(-(np.array(v, np.float32).astype(float) * query).sum(), i)
              for i, v in vectors.items() if i != query_id]
    return [(i, -s) for s, i in sorted(scores)[:k]]


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.normal(size=8).tolist() for i in range(15)}
    good |= {100 + i: good[3] for i in range(12)}  # ties
    bad = [(50, None), (60, []), (70, [0.0] * 8), (80, [float("nan")] * 8), (90, [1.0] * 7),
           (95, [None] * 8), (97, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    rows = [(i, v, 0) for i, v in [*good.items(), *bad]]
    docs = spark.createDataFrame(rows, VECTORS).withColumns(
        {name: F.lit(1) for name in ("vector", "keys", "slice", "rank", "score")})
    got = {}
    for r in ann.search(docs, every_nth=20, k=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    kept = {i: np.array(v, np.float32).tolist() for i, v in good.items()}
    want = {q: [(n + 1, i, pytest.approx(s)) for n, (i, s) in enumerate(ranked(kept, q, 20))]
            for q in kept if q % 20 == 0}
    assert got.keys() == want.keys()
    for query, rows in got.items():
        assert sorted(rows) == want[query]


def test_rows_that_repeat_an_id_are_candidates_each(spark):
    """Against all pairs of rows; the far vector of id 7 is the nearest of every query."""
    rng = np.random.default_rng(4)
    rows = [(i % 60, rng.normal(size=3).tolist(), 0) for i in range(90)]
    rows += [(7, [50.0, 50.0, 50.0], 0), (7, [-50.0, 50.0, 1.0], 0), (20, rows[0][1], 0)]
    table = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows]
    want = []
    for at, (query, vector) in enumerate(table):
        if query % 20 == 0:
            near = sorted((-(v * vector).sum(), i) for place, (i, v) in enumerate(table)
                          if place != at)[:20]
            want += [(query, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(near)]
    got = ann.search(spark.createDataFrame(rows, VECTORS).repartition(3), 20, 20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == sorted(want)


def test_no_vectors(spark):
    assert ann.search(spark.createDataFrame([], VECTORS), 20, 20).count() == 0


def test_recall(spark):
    """The driver's vectors have no near neighbours, so this is the hard case."""
    sf = "/root/testdata/sf0.01"
    table = {r.vec_id: r.embedding for r in
             spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    found = Counter()
    rows = op6_multiprobe_search(spark, sf).collect()
    for query in {r.query_id for r in rows}:
        best = dict(ranked(table, query, 20))
        found["hit"] += sum(r.query_id == query and r.vec_id in best for r in rows)
        found["all"] += 20
    assert len(rows) == found["all"] and found["hit"] >= 0.9 * found["all"]


PAGES = "page_id bigint, url string, html string"


def expected(rows):
    first, times = {}, Counter(h or "" for _, _, h in rows)
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    for p, _, h in rows:
        body = (h or "").encode()
        of = first.get(h or "")
        revisit = times[h or ""] > 1 and p != of
        yield (p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
               "revisit" if revisit else "response", of if revisit else None)


def page_rows():
    rows = [(i, f"http://h{i % 3}.example.com/a b/{i // 50}?q={i % 2}" if i % 7 else None,
             ["same", " x" * i, None, "é\r\n\r\nz"][i % 4]) for i in range(200)]
    return rows + [(None, "http://x.y/", "same"), (None, None, None), (-3, "::bad[url", "same"),
                   (5, "http://d.e/", "dup"), (5, "http://d.e/", "dup"), (9, "http://d.e/", "dup"),
                   (300, "http://long.example/" + "p" * 5000, "y" * 200000)]


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_LINES", 60)
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).withColumns(
        {name: F.lit(1) for name in ("key", "file", "payload", "same")}).repartition(3)
    archives, index = str(tmp_path / "a"), str(tmp_path / "i")
    captures = warc.write_archives(pages, archives)
    parts = warc.write_index(captures, index, block_lines=5)
    assert parts.count() > 1
    found = warc.look_up(parts, index, archives, pages.select("url", "page_id"))
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, got.collect())) == Counter(expected(rows))
    bodies = {(p, (h or "").encode()) for p, _, h in rows}
    assert all((r.page_id, bytes(r.payload)) in bodies for r in found.collect()
               if r.record_type == "response")


def test_a_repeated_task_adds_no_record(spark, tmp_path, monkeypatch):
    """What another attempt leaves in the folders is read by nobody."""
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "SCAN", 700)
    rows = page_rows()
    archives, index = tmp_path / "a", tmp_path / "i"
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    warc.write_index(warc.write_archives(pages, str(archives)), str(index), block_lines=5)
    listed = warc.manifest(spark, str(archives)).collect()
    assert len(listed) > 3 and sum(r.records for r in listed) == len(rows)
    assert {r.file: r.bytes for r in listed} == {
        p.name: p.stat().st_size for p in archives.glob("*.warc.gz")}
    for path in [*archives.glob("part-*"), *index.glob("index-*")]:
        shutil.copy(path, path.with_name(path.name.replace("-", "-9", 1)))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    scanned = warc.records(spark, str(archives))
    assert Counter(map(tuple, scanned.select(*names).collect())) == Counter(expected(rows))
    found = warc.look_up(warc.index_parts(spark, str(index)), str(index), str(archives),
                         pages.select("url", "page_id"))
    assert Counter(map(tuple, found.select(*names, "file", "offset").collect())) == Counter(
        map(tuple, scanned.select(*names, "file", "offset").collect()))
    whole = (archives / listed[0].file).read_bytes()
    (archives / listed[0].file).write_bytes(whole[:-9])
    with pytest.raises(Exception, match="ends within a record"):
        warc.records(spark, str(archives)).collect()


def test_names_of_storage():
    assert files.known_uri("s3a://lake/a:b") == "s3://lake/a:b"
    assert files.known_uri("hdfs://n:8020/x") == "hdfs://n:8020/x"
    assert files.known_uri("file:/x") == "file:/x" and files.known_uri("/x") == "/x"


def test_unknown_pages_are_not_found(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), PAGES)
    parts = warc.write_index(warc.write_archives(pages, str(tmp_path / "a")), str(tmp_path / "i"))
    wanted = spark.createDataFrame([("http://none.example/", 1), (None, 10 ** 9)],
                                   "url string, page_id bigint")
    assert warc.look_up(parts, str(tmp_path / "i"), str(tmp_path / "a"), wanted).count() == 0


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def test_url_keys_sort_by_reversed_host():
    assert warc.url_key("https://blog.Example.com/p?a=1#x") == "com,example,blog)/p?a=1"
    assert warc.url_key("http://a.b:8080") == "b,a:8080)/"
    assert " " not in warc.url_key("http://a.b/x y") and warc.url_key(None) == "-"
