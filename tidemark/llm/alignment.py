"""Alignment of the tokens of two tokenizers, and how often ids are linked.

Both tokenizers see the same bytes: the text behind a blank. Byte offsets where a token of
either side ends cut a text into groups; two tokens are linked where their byte ranges overlap.
All that happens on Arrow arrays of a few documents at a time:

1. Ids are flattened, with the parent index of each. Running sums of the tokens' byte
   lengths give their ends; taken over all documents in a row, an end is a key that names the
   document, too.
2. A full hash join of both sides' ends tells which ends both have: those cut the groups.
   Sorted, each end stands for one stretch of bytes without a border, which is one link; running
   counts of either side's ends name the tokens that cover it.
3. Links are counted per pair of ids (``Table.group_by``). Spark merges these partial counts.

A piece of a task's documents, with its links as numbers into the piece's own list of pairs,
is stored as one row. The merged counts go back to each piece by a join on the pair, one row
per pair and piece rather than per link, and a document's sums are taken over its own links.
The answers are dealt by piece and sorted with the piece's row behind them, so no list of them
is built in the JVM, and a batch that a worker takes holds the rows of few pieces.

Memory does not grow with the table: pieces are small, links are packed, and what Arrow has
set aside for a piece is given back before the next one.

Defined cases: texts that are null or empty, and those whose tokens of either side don't spell
the text behind a blank (a normaliser changed it), have no tokens. Strings of special tokens
are plain text. Rows that repeat an id are documents of their own. Other columns never matter.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.tokens import Encoder, byte_letters

PIECE = 1 << 19     # bytes of text a task works on at once, or one text
SHIFT = 1 << 20     # a pair of ids as one number: a * SHIFT + b
BLANK = "▁"    # fixed value: how the second vocabulary writes a blank


class ByteTokens:
    """The first side: byte-level merges, ids and their bytes."""

    def __init__(self, path: str):
        self.path, self.encoder = path, Encoder(path)
        with open(path, encoding="utf-8") as file:
            words = json.load(file)["model"]["vocab"]
        letters, raw = byte_letters(), [b""] * self.encoder.library.get_vocab_size()
        for token, number in words.items():
            raw[number] = bytes(letters[c] for c in token if c in letters)
        self.raw = pa.array(raw, pa.binary())

    @cached_property
    def library(self):
        """Only for texts that the faster library can't take: special tokens are plain text."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.encode_special_tokens = True
        return library

    def ids(self, text: str) -> np.ndarray:
        if self.encoder.fast is None or self.encoder.long_run(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.encoder.fast.encode_to_numpy(text, disallowed_special=())

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [self.ids(" " + t) if t else np.zeros(0, np.uint32) for t in texts]


class PieceTokens:
    """The second side: pieces with byte fallback, which put a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        raw = []
        for number in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(number)
            raw.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(number)
                       else piece.replace(BLANK, " ").encode())
        self.raw = pa.array(raw, pa.binary())

    def encoded(self, texts: list[str]) -> list[list[int]]:
        found = self.library.encode(texts, num_threads=1)
        return [ids if t else [] for ids, t in zip(found, texts)]


@lru_cache(maxsize=4)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@lru_cache(maxsize=4)
def piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)


def listed(values: list) -> pa.ListArray:
    counts = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.concatenate([np.zeros(0, np.uint32), *(np.asarray(v, np.uint32) for v in values)])
    return pa.ListArray.from_arrays(pa.array(offsets(counts), pa.int32()),
                                    pa.array(flat.astype(np.int32)))


def offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def bytes_of(ids: pa.ListArray, raw: pa.Array) -> pa.Array:
    """Each list's tokens as one string of bytes."""
    tokens = pc.take(raw, ids.flatten())
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens), b"")


class Aligned:
    """Tokens of some documents, cut into groups, and their links."""

    def __init__(self, a: pa.ListArray, b: pa.ListArray, raw_a: pa.Array, raw_b: pa.Array):
        self.a, self.b = a.flatten(), b.flatten()
        self.parent_a, self.parent_b = pc.list_parent_indices(a), pc.list_parent_indices(b)
        ends_a, ends_b = (self.ends(ids, raw) for ids, raw in ((self.a, raw_a), (self.b, raw_b)))
        left = pa.table({"end": ends_a, "a": np.ones(len(ends_a), np.int64)})
        right = pa.table({"other": ends_b, "b": np.ones(len(ends_b), np.int64)})
        both = left.join(right, "end", "other", "full outer", coalesce_keys=True,
                         use_threads=False).sort_by("end")
        has_a, has_b = (pc.fill_null(both.column(c), 0).combine_chunks() for c in ("a", "b"))
        # The token that covers the bytes before an end is the first one not yet ended there.
        self.link_a, self.link_b = (
            pc.subtract(pc.cumulative_sum(has), has) for has in (has_a, has_b))
        shared = pc.equal(pc.add(has_a, has_b), 2)
        self.cut_a = pc.filter(pc.add(self.link_a, 1), shared).to_numpy(zero_copy_only=False)
        self.cut_b = pc.filter(pc.add(self.link_b, 1), shared).to_numpy(zero_copy_only=False)

    @staticmethod
    def ends(ids: pa.Array, raw: pa.Array) -> pa.Array:
        """Ends of tokens in the bytes of all documents in a row."""
        return pc.cumulative_sum(pc.take(pc.binary_length(raw).cast(pa.int64()), ids))

    def per_document(self, parents: pa.Array, count: int) -> np.ndarray:
        return np.bincount(parents.to_numpy(zero_copy_only=False), minlength=count)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The document and the pair of ids of every link."""
        pair = pc.add(pc.multiply(pc.take(self.a, self.link_a).cast(pa.int64()), SHIFT),
                      pc.take(self.b, self.link_b).cast(pa.int64()))
        return (pc.take(self.parent_a, self.link_a).to_numpy(zero_copy_only=False),
                pair.to_numpy(zero_copy_only=False))

    def groups(self) -> tuple[np.ndarray, pa.Array]:
        """The document of every group, and its ids as ``a1,a2|b1``."""
        sides = []
        for ids, cuts in ((self.a, self.cut_a), (self.b, self.cut_b)):
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], cuts]), pa.int32()), decimals(ids))
            sides.append(pc.binary_join(lists, ","))
        parents = self.parent_a.to_numpy(zero_copy_only=False)
        return parents[self.cut_a - 1], pc.binary_join_element_wise(*sides, "|")


def packed(links: np.ndarray, pairs: int) -> bytes:
    """Numbers into a list of ``pairs``, in the narrowest type, compressed."""
    return pa.compress(links.astype(link_type(pairs)).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, links: int, pairs: int) -> np.ndarray:
    kind = link_type(pairs)
    return np.frombuffer(
        pa.decompress(data, links * kind.itemsize, "zstd", asbytes=True) if links else b"", kind)


def link_type(pairs: int) -> np.dtype:
    return np.dtype("<u2" if pairs <= 1 << 16 else "<u4")


def decimals(ids: pa.Array) -> pa.Array:
    return ids.cast(pa.string())


def piece_row(names: pa.Array, texts: list[str | None], first: ByteTokens,
              second: PieceTokens) -> dict:
    """One stored row: what is known of each document, the pairs, and the links."""
    texts = [t or "" for t in texts]
    given = pa.array([b" " + t.encode() if t else b"" for t in texts], pa.binary())
    a, b = listed(first.encoded(texts)), listed(second.encoded(texts))
    same = pc.and_(pc.equal(bytes_of(a, first.raw), given), pc.equal(bytes_of(b, second.raw), given))
    if not pc.all(same).as_py() and len(texts):
        keep = same.to_numpy(zero_copy_only=False)
        a, b = (listed([v if k else [] for v, k in zip(x.to_pylist(), keep)]) for x in (a, b))
    found, count = Aligned(a, b, first.raw, second.raw), len(texts)
    doc_of_link, pairs = found.links()
    doc_of_group, groups = found.groups()
    group_counts = np.bincount(doc_of_group, minlength=count)
    joined = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(offsets(group_counts), pa.int32()), groups), ";")
    partial = pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate(
        [([], "count_all")]).sort_by("pair")
    known = partial.column("pair").to_numpy()
    return {
        "doc_id": names, "n_a": found.per_document(found.parent_a, count),
        "n_b": found.per_document(found.parent_b, count), "n_groups": group_counts,
        "n_links": np.bincount(doc_of_link, minlength=count),
        "groups_sha256": [hashlib.sha256(g.encode()).hexdigest() if g else ""
                          for g in joined.to_pylist()],
        "pair": known, "n": partial.column("count_all").to_numpy(),
        "links": packed(np.searchsorted(known, pairs), len(known)),
    }


DOCUMENT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def document_bytes(row: dict) -> bytes:
    """What is known of a piece's documents, as an Arrow stream of one batch."""
    kinds = {"groups_sha256": pa.string(), "doc_id": row["doc_id"].type}
    batch = pa.RecordBatch.from_arrays(
        [row[n] if n == "doc_id" else pa.array(row[n], kinds.get(n, pa.int64())) for n in DOCUMENT],
        list(DOCUMENT))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def pieces(docs: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """A row per piece: its pairs of ids with their counts, its documents, its links."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_tokens(first_path), piece_tokens(second_path)
        part, number = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(
                zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < len(batch):
                taken = sizes[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, taken + PIECE, "right")))
                some = batch.slice(begin, end - begin)
                row = piece_row(some.column(0), some.column(1).to_pylist(), first, second)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part + number], pa.int64()),
                     pa.array([row["pair"]], pa.list_(pa.int64())),
                     pa.array([row["n"]], pa.list_(pa.int64())),
                     pa.array([document_bytes(row)], pa.binary()),
                     pa.array([row["links"]], pa.binary())],
                    ["piece", "pair", "n", "documents", "links"])
                del row
                pa.default_memory_pool().release_unused()
                begin, number = end, number + 1

    return docs.select("doc_id", "text").mapInArrow(
        align, "piece bigint, pair array<bigint>, n array<bigint>, documents binary, links binary")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, count, best)``: links per pair of ids, and whether its second id has none with
    more. The highest counts per second id are as many rows as the vocabulary has at most."""
    counts = stored(rows.select(F.explode(F.arrays_zip("pair", "n")).alias("p")).groupBy(
        F.col("p.pair").alias("pair")).agg(F.sum("p.n").alias("count")))
    second = F.pmod("pair", F.lit(SHIFT))
    highest = stored(counts.groupBy(second.alias("second")).agg(F.max("count").alias("most")))
    return counts.join(highest, second == F.col("second")).select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(pieces(docs, first_path, second_path), compression="zstd")
    counts = stored(pair_counts(rows))
    # The row of a piece comes behind the answers to its pairs. All columns are flat: Spark's
    # Arrow writer takes time with the square of the rows for null lists.
    answers = rows.select("piece", F.posexplode("pair").alias("place", "pair")).join(
        counts, "pair").select(
            "piece", "place", (F.col("count") * 2 + F.col("best").cast("bigint")).alias("answer"),
            F.lit(None).cast("binary").alias("documents"), F.lit(None).cast("binary").alias("links"))
    whole = rows.select("piece", F.size("pair").alias("place"),
                        F.lit(None).cast("bigint").alias("answer"), "documents", "links")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []  # answers to the piece whose row comes next
        for batch in batches:
            known, begin = batch.column("answer"), 0
            ends_piece = batch.column("documents").is_valid().to_numpy(zero_copy_only=False)
            for at in np.flatnonzero(ends_piece).tolist():
                held.append(known.slice(begin, at - begin))
                answer = pa.chunked_array(held, pa.int64()).to_numpy()
                held, begin = [], at + 1
                one = pa.ipc.open_stream(batch.column("documents")[at].as_py()).read_next_batch()
                ends = offsets(one.column("n_links").to_numpy())
                links = unpacked(batch.column("links")[at].as_py(), int(ends[-1]), len(answer))
                best, total = (v[ends[1:]] - v[ends[:-1]] for v in (
                    offsets(values[links]) for values in (answer & 1, answer >> 1)))
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:5], pa.array(best), pa.array(total), one.column("groups_sha256")],
                    [*DOCUMENT[:5], "n_best", "count_sum", "groups_sha256"])
            held.append(known.slice(begin))

    return answers.union(whole).repartition("piece").sortWithinPartitions("piece", "place").select(
        "answer", "documents", "links").mapInArrow(
        add_up, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                "n_best bigint, count_sum bigint, groups_sha256 string")
