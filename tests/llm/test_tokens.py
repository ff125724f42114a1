from __future__ import annotations

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import ODD, SCHEMA, clashing, documents, prose
from tidemark.llm import packing, token_counts, training_order
from tidemark.llm.queries import BPE, vocabulary_path
from tidemark.llm.tokens import Encoder, tokenizer

PATH = vocabulary_path(BPE)
PARTS = ["a", " ", "\n", "  ", "'s", "'", "<|endoftext|>", "'re", "!", "é", "\t", "\xa0", "　",
         "Zth", "<|", "th", "12", "\x1c", "漢", "\r\n"]


def mixtures(count, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(1, longest))) for _ in range(count)]


def ids(text):
    return tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s():
    encode = Encoder(PATH)
    assert encode.fast is not None
    for text in ["", None, *mixtures(2000, 30, 1), prose(3, 500), "ab" * 5000]:
        assert encode.array(text).tolist() == ids(text)


@pytest.mark.parametrize("run", [" " * 1_500_000, " \n" * 600_000, "\xa0" * 1_000_000])
def test_very_long_white_space(run):
    encode = Encoder(PATH)
    for text in [run, f"a b{run}c <|endoftext|> d"]:
        assert encode.array(text).tolist() == ids(text)


def test_very_long_white_space_in_queries(spark):
    rows = [*ODD[:3], (20, "a" + " " * 1_100_000 + "b")]
    docs = documents(spark, rows)
    check_pieces(list(map(tuple, packing.with_checksums(packing.packed(docs, PATH)).collect())),
                 rows, packing.WINDOW)


def test_every_character_has_the_library_s_ids():
    encode = Encoder(PATH)
    for c in range(0, 0x110000, 7):  # a full run found no difference either
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1{chr(c)} {chr(c)}!"
            assert encode.array(text).tolist() == ids(text)


def test_prefix_tables():
    counts = token_counts.PrefixCounter(PATH)
    for text in [*mixtures(250, 18, 2), "don't 're'll", prose(4, 12), " " * 30 + "x", ""]:
        want = [len(ids(text[:i])) for i in range(1, len(text) + 1)]
        assert counts.table(text).tolist() == want
        assert counts.total(text) == len(ids(text))
        for budget in (0, 3, 7):
            fits = [i + 1 for i, n in enumerate(want) if n <= budget]
            assert counts.longest(text, budget) == max(fits, default=0)


def test_runs_of_texts_are_counted_without_merging(monkeypatch):
    counts = token_counts.PrefixCounter(PATH)
    monkeypatch.setattr(counts.merges, "merged", None)
    monkeypatch.setattr(token_counts, "RUN_CHARS", 3000)
    monkeypatch.setattr(token_counts, "REMEMBERED", 400)
    texts = ["", *mixtures(300, 18, 5), prose(5, 3000), "don't 're'll", prose(6, 40), " " * 30 + "x",
             "a\nb c\nd", prose(5, 3000)]
    assert counts.totals(texts) == [len(ids(t)) for t in texts]
    assert len(counts.tables.words) <= 400 and len(counts.pieces) <= 100


def test_pieces_that_begin_alike_share_their_prefixes():
    merges, counted = token_counts.Merges(PATH), []
    pieces = sorted({w.encode() for w in prose(7, 400).split()})
    alone = [token_counts.Merges.prefixes(merges, p) for p in reversed(pieces)][::-1]

    class Counted(list):
        def append(self, value):
            counted.append(value)
            super().append(value)

    merges.piece, merges.counts = b"", Counted([0])
    merges.last, merges.starts = [0], [0]
    assert [list(merges.prefixes(p)) for p in pieces] == alone
    assert len(counted) < 0.8 * sum(map(len, pieces))


def test_pairs_fit_as_merging_has_it(tmp_path):
    merges, rng = token_counts.Merges(PATH), random.Random(3)
    tokens = list(merges.raw)
    keys = [rng.choice(tokens[:3000]) << 20 | rng.choice(tokens[:3000]) for _ in range(3000)]
    for token, (a, b) in list(merges.halves.items())[::7]:
        keys += [a << 20 | b, a << 20 | token, token << 20 | b, b << 20 | a]
    found = [merges.fit(key) for key in keys]
    merges.halves = None
    merges.fits.clear()
    assert found == [merges.fit(key) for key in keys] and 0 < sum(found) < len(found)

    with open(PATH, encoding="utf-8") as file:
        content = json.load(file)
    vocab, (x, y) = content["model"]["vocab"], ("th", "er")
    vocab[x], vocab[y] = vocab[y], vocab[x]  # ids that don't follow the order of the merges
    path = str(tmp_path / "swapped.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(content, file)
    counts, texts = token_counts.PrefixCounter(path), [*mixtures(100, 18, 8), prose(8, 300)]
    assert counts.merges.halves is None
    assert counts.totals(texts) == [len(ids(t)) for t in texts]


def test_token_counts(spark):
    found = token_counts.token_counts(clashing(documents(spark, ODD)), PATH, limit=50, tables=True)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect())
    assert got == Counter(
        (i, len((t or "").encode()), len(ids(t)), len(ids(t)) > 50) for i, t in ODD)
    for r in found.collect():
        assert len(r.prefix_tokens) == 0 or r.prefix_tokens[-1] == r.n_tokens
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def check_pieces(rows, documents_, window):
    """Pieces of (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    streams = Counter((d, np.array([*ids(t), 1], "<u4").tobytes()) for d, t in documents_)
    by_place = sorted(rows, key=lambda r: (r[5], r[6]))
    at = 0
    whole = defaultdict(list)
    for r in by_place:  # gapless, in windows
        assert r[5] * window + r[6] == at and r[6] + r[2] <= window and r[2] > 0
        at += r[2]
        whole[r[0], at - r[2] - r[1]].append(r)
    assert at == sum(len(s) // 4 * n for (_, s), n in streams.items())
    found = Counter()
    for (doc_id, _), pieces in whole.items():
        candidates = [s for d, s in streams if d == doc_id and len(s) // 4 == pieces[0][4]]
        match = [s for s in candidates
                 if all(zlib.crc32(s[4 * p[1]:4 * (p[1] + p[2])]) == p[3] for p in pieces)]
        assert match and sum(p[2] for p in pieces) == pieces[0][4]
        found[doc_id, match[0]] += 1
    assert found == streams


@pytest.mark.parametrize("window", [7, 2048])
def test_packing(spark, window):
    docs = clashing(documents(spark, ODD)).repartition(3)
    rows = packing.with_checksums(packing.packed(docs, PATH, window)).collect()
    check_pieces(list(map(tuple, rows)), ODD, window)
    assert packing.packed(spark.createDataFrame([], SCHEMA), PATH).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 65, 1000])
def test_permutation(count):
    order = training_order.Permutation(count, 5)
    slots = order.slots(np.arange(count))
    assert sorted(slots) == list(range(count))
    assert order.numbers(slots).tolist() == list(range(count))


def test_training_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(training_order, "SHARD", 4)
    monkeypatch.setattr(training_order, "LENGTH", 512)
    docs = clashing(documents(spark, ODD)).coalesce(2)
    folder = str(tmp_path / "shards")
    rows = sorted(training_order.materialised(docs, PATH, folder).collect(), key=lambda r: r.slot)
    stored = list(training_order.read_from(folder))
    assert [zlib.crc32(s.tobytes()) for s in stored] == [r.ids_crc32 for r in rows]
    assert [s.tolist() for s in training_order.read_from(folder, 3, 6)] == [
        s.tolist() for s in stored[3:6]]  # resumed
    stream = [n for r, s in sorted(zip(rows, stored), key=lambda p: p[0].sequence)
              for n in s[:r.n_tokens].tolist()]
    assert sorted(stream) == sorted(n for _, t in ODD for n in [*ids(t), training_order.END_ID])
    empty = spark.createDataFrame([], SCHEMA)
    assert training_order.materialised(empty, PATH, str(tmp_path / "none")).count() == 0


def test_every_slot_holds_the_sequence_that_the_permutation_names(spark, tmp_path, monkeypatch):
    """The exact ids at every slot, against one stream cut and dealt by plain Python."""
    monkeypatch.setattr(training_order, "SHARD", 3)
    monkeypatch.setattr(training_order, "LENGTH", 64)
    rows = [*ODD, *((100 + i, prose(i, 5 * i)) for i in range(40))]
    stream = [n for _, t in rows for n in [*ids(t), training_order.END_ID]]
    cut = [stream[i:i + 64] for i in range(0, len(stream), 64)]
    cut[-1] += [training_order.PAD] * (64 - len(cut[-1]))
    keys = [int(k) for k in np.random.default_rng(9).integers(0, 1 << 63, training_order.ROUNDS)]
    half = max(1, ((len(cut) - 1).bit_length() + 1) // 2)

    def slot(number):
        while True:
            left, right = number >> half, number & (1 << half) - 1
            for key in keys:
                x = (right + key) % 2 ** 64
                x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2 ** 64
                x = (x ^ x >> 27) * 0x94D049BB133111EB % 2 ** 64
                left, right = right, left ^ (x ^ x >> 31) & (1 << half) - 1
            number = left << half | right
            if number < len(cut):
                return number

    docs, folder = documents(spark, rows).coalesce(1), str(tmp_path / "shards")
    found = training_order.materialised(docs, PATH, folder, key=9, run=4).collect()
    assert {r.sequence: r.slot for r in found} == {i: slot(i) for i in range(len(cut))}
    stored = [s.tolist() for s in training_order.read_from(folder)]
    assert len(stored) == len(cut) > 4 * 3
    assert all(stored[slot(i)] == piece for i, piece in enumerate(cut))


def test_wide_vocabulary(spark, tmp_path, monkeypatch):
    """Ids beyond 16 bits come back whole, and are refused where they don't fit."""
    monkeypatch.setattr(training_order, "LENGTH", 64)
    with open(PATH, encoding="utf-8") as file:
        content = json.load(file)
    wide = {n: i + 70_000 if i > 255 else i for n, i in content["model"]["vocab"].items()}
    content["model"]["vocab"] = wide
    for token in content["added_tokens"]:
        token["id"] = wide.get(token["content"], token["id"])
    path = str(tmp_path / "wide.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(content, file)
    with pytest.raises(ValueError, match="fit"):
        Encoder(path, "<u2")
    rows = [(1, prose(1, 200)), (2, "the same text")]
    folder = str(tmp_path / "shards")
    docs = documents(spark, rows).coalesce(1)
    found = training_order.materialised(docs, path, folder).collect()
    assert {r.offset for r in found} == {r.slot * 64 * 4 for r in found}
    stored = dict(zip(sorted(r.slot for r in found), training_order.read_from(folder)))
    stream = [n for r in sorted(found, key=lambda r: r.sequence)
              for n in stored[r.slot][:r.n_tokens].tolist()]
    want = [n for _, t in rows for n in
            [*tokenizer(path).encode(t, add_special_tokens=False).ids, training_order.END_ID]]
    assert sorted(stream) == sorted(want) and max(want) > 1 << 16
