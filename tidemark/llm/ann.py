"""Nearest neighbours by largest inner product, with multiprobe p-stable hashing.

Every vector gets one more coordinate that brings it to the largest length in the table, and
queries a zero there; the nearest by Euclidean distance then have the largest inner product.
Each of ``TABLES`` tables cuts ``WIDTHS`` random Gaussian projections into steps; the steps
name a bucket. A query visits, over all tables, the buckets whose perturbation of its own
steps is most likely to hold near vectors: the sum of the squared distances to the crossed
step borders, least first. Vectors from all visited buckets are merged, and compared by
their true inner product in double precision.

Vectors are dealt out in slices by a hash of their row's number, so equal vectors, repeated
ids and full buckets spread over all tasks. Blocks of queries visit every slice; each task yields the best ``k``
per query, and these are merged. Nothing but the largest length reaches the driver.

Defined cases: vectors that are null, empty, zero, of another length than most, or that hold
null or non-finite numbers take no part, nor do rows without an id. Rows that repeat an id are
each a query and a candidate of their own, also of one another. Ties go to the smaller id. A slice in which a query's buckets
hold fewer than ``LEAST * k`` vectors is compared whole, so small tables are answered exactly. An
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

TABLES = 16
WIDTHS = 6
STEP = 1.5        # of a step, for vectors of length 1
PROBES = 64       # buckets a query visits, per table on average
LEAST = 10        # times k: a slice that offers fewer vectors is compared whole
SLICE = 8192      # vectors, and queries, a task compares
SEED = 41

_PRIME = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """Bucket keys of vectors, and the keys a query visits, best first."""

    def __init__(self, dimension: int, longest: float):
        rng = np.random.default_rng(SEED)
        self.longest = longest
        self.directions = rng.normal(size=(dimension + 1, TABLES * WIDTHS))
        self.starts = rng.random(TABLES * WIDTHS)
        self.moves = np.array(list(itertools.product((0, -1, 1), repeat=WIDTHS)))
        self.salts = np.arange(1, TABLES + 1, dtype=np.uint64) * _PRIME

    def steps(self, vectors: np.ndarray, last: np.ndarray) -> np.ndarray:
        extended = np.column_stack([vectors, last]) / self.longest
        return (extended @ self.directions / STEP + self.starts).reshape(-1, TABLES, WIDTHS)

    def keys(self, steps: np.ndarray, tables: np.ndarray | slice = slice(None)) -> np.ndarray:
        found = np.broadcast_to(self.salts[tables], steps.shape[:-1]).copy()
        for i in range(WIDTHS):
            found = (found ^ steps[..., i].astype(np.int64).view(np.uint64)) * _PRIME
            found ^= found >> np.uint64(31)
        return found.view(np.int64)

    def stored_keys(self, vectors: np.ndarray) -> np.ndarray:
        missing = self.longest ** 2 - (vectors ** 2).sum(axis=1)
        return self.keys(np.floor(self.steps(vectors, np.sqrt(np.maximum(missing, 0)))))

    def probes(self, query: np.ndarray) -> np.ndarray:
        """Keys in estimated order of success. A query's length doesn't matter."""
        unit = query * (self.longest / np.linalg.norm(query))
        steps = self.steps(unit[None], np.zeros(1))[0]
        base = np.floor(steps)
        below = steps - base
        costs = np.stack([np.zeros_like(below), (1 - below) ** 2, below ** 2])  # moves 0, 1, -1
        total = costs[self.moves, :, np.arange(WIDTHS)].sum(axis=1)  # moves x tables
        move, of_table = np.unravel_index(
            np.argsort(total, axis=None, kind="stable")[:PROBES * TABLES], total.shape)
        return self.keys(base[of_table] + self.moves[move], of_table)


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part."""
    number = F.col("vector")
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & number.isNotNull()
        & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(number, lambda x: x != 0))


def indexed(vectors: DataFrame) -> tuple[DataFrame, Hasher | None]:
    """``(vec_id, vector, row, keys)`` of every usable row, stored, and the hasher. ``row``
    is a number that tells rows apart; it is stored before anything uses it."""
    rows = stored(usable(vectors).withColumn("row", F.monotonically_increasing_id()))
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    dimension = sizes.orderBy(F.desc("count"), "size").limit(1).first()
    if dimension is None:
        return rows.withColumn("keys", F.lit(None).cast("array<bigint>")), None
    rows = rows.where(F.size("vector") == dimension["size"])
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    longest = rows.agg(F.max(F.sqrt(square))).first()[0]
    hasher = Hasher(dimension["size"], longest)

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = hasher.stored_keys(matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))],
                ["vec_id", "vector", "row", "keys"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return stored(rows.mapInArrow(
        hash_all, f"vec_id {kind}, vector array<double>, row bigint, keys array<bigint>")), hasher


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores in order, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


class Slice:
    """A slice of the index: its vectors, and their places by bucket key."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray,
                 keys: np.ndarray):
        self.ids, self.rows, self.vectors = ids, rows, vectors
        flat = keys.ravel()
        order = np.argsort(flat, kind="stable")
        self.sorted, self.places = flat[order], order // keys.shape[1]

    def visited(self, probes: np.ndarray) -> np.ndarray:
        begin = np.searchsorted(self.sorted, probes, "left")
        end = np.searchsorted(self.sorted, probes, "right")
        found = np.zeros(len(self.ids), bool)
        for i, j in zip(begin, end):
            if i < j:
                found[self.places[i:j]] = True
        return found

    def nearest(self, row: int, query: np.ndarray, probes: np.ndarray, k: int):
        other = self.rows != row
        found = np.flatnonzero(self.visited(probes) & other)
        if len(found) < LEAST * k:
            found = np.flatnonzero(other)
        vectors = self.vectors[found]
        rough = vectors @ query
        if len(found) > k:  # equal vectors must get equal scores: sum the close ones one by one
            least = np.partition(rough, len(rough) - k)[len(rough) - k]
            close = rough >= least - 1e-9 * (1 + abs(least))
            found, vectors = found[close], vectors[close]
        scores = (vectors * query).sum(axis=1)
        places = best(scores, self.ids[found], k)
        return self.ids[found[places]], scores[places]


def nearest(index: DataFrame, hasher: Hasher | None, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest of each row of ``queries``."""
    kind = index.schema["vec_id"].dataType.simpleString()
    schema = f"query_row bigint, query_id {kind}, vec_id {kind}, score double"
    if hasher is None:
        return index.sparkSession.createDataFrame([], schema).select(
            "query_id", F.lit(0).alias("rank"), "vec_id", "score")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [hasher.probes(v) for v in matrix(batch.column(1))] if len(batch) else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64()))],
                ["vec_id", "vector", "row", "keys"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_task(batches):
            asking = group.column("asking").to_numpy(zero_copy_only=False)
            stock, asked = (group.filter(pa.array(asking == flag)) for flag in (False, True))
            if not len(stock) or not len(asked):
                continue
            ids = stock.column("vec_id").to_numpy(zero_copy_only=False)
            part = Slice(ids, stock.column("row").to_numpy(), matrix(stock.column("vector")),
                         matrix(stock.column("keys")))
            vectors, probes = matrix(asked.column("vector")), matrix(asked.column("keys"))
            names, rows = (asked.column(c).to_pylist() for c in ("vec_id", "row"))
            for at, (name, row) in enumerate(zip(names, rows)):
                found, scores = part.nearest(row, vectors[at], probes[at], k)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(found), pa.int64()),
                         pa.array([name] * len(found), asked.schema.field("vec_id").type),
                         pa.array(found, asked.schema.field("vec_id").type), pa.array(scores)],
                        ["query_row", "query_id", "vec_id", "score"])

    asked = stored(queries.mapInArrow(
        probe, f"vec_id {kind}, vector array<double>, row bigint, keys array<bigint>"))
    slices, blocks = (max(1, -(-df.count() // SLICE)) for df in (index, asked))

    def dealt(salt: int, count: int):
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    columns = ("vec_id", "vector", "row", "keys")
    tasks = index.select(dealt(1, slices).alias("slice"), every(blocks).alias("block"),
                         F.lit(False).alias("asking"), *columns).unionAll(
        asked.select(every(slices).alias("slice"), dealt(2, blocks).alias("block"),
                     F.lit(True).alias("asking"), *columns))
    found = (tasks.repartition(slices * blocks, "slice", "block")
             .sortWithinPartitions("slice", "block").mapInArrow(search, schema))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one task after another; rows of a task stand together."""
    key, parts = None, []
    for batch in batches:
        slices, blocks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero(np.diff(slices) | np.diff(blocks)) + 1
        for begin, end in itertools.pairwise([0, *cuts, len(batch)] if len(batch) else []):
            if (slices[begin], blocks[begin]) != key:
                if parts:
                    yield pa.Table.from_batches(parts).combine_chunks()
                key, parts = (slices[begin], blocks[begin]), []
            parts.append(batch.slice(begin, end - begin))
    if parts:
        yield pa.Table.from_batches(parts).combine_chunks()


def search(vectors: DataFrame, every_nth: int, k: int) -> DataFrame:
    """Search for the rows of ``vectors`` whose id is divisible by ``every_nth``."""
    index, hasher = indexed(vectors)
    queries = index.where(F.col("vec_id") % every_nth == 0).select("vec_id", "vector", "row")
    return nearest(index, hasher, queries, k)
