"""Near duplicates by circulant MinHash, with exact confirmation on whole sets.

A document's set holds its distinct word shingles, as 64-bit hashes. Two permutations of
the 32-bit numbers make all signature coordinates: the first scatters the shingles, the
second, shifted by k, gives coordinate k as its least value over the set. Coordinates form
bands; documents that agree on a band share a bucket. The number of bands follows from the
threshold, so that a pair at the threshold is missed with probability ``MISS`` at most.

1. Documents with equal sets form one class; only classes go on.
2. In buckets of more than ``BLOCK`` classes, every class is compared with the bucket's
   least one, on whole sets. What links up there needs no further comparison.
3. In each bucket whose classes still belong to different groups, signatures tell which of
   those classes can't reach the threshold (again with probability ``MISS``); the others
   form candidate clusters.
4. All classes of a cluster that belong to different groups are compared on whole sets.
   Clusters and buckets beyond ``BLOCK`` are split into blocks against blocks, so a task
   never holds more than two blocks, and no pair is left out.

What leaves a task is at most one link per class it holds, never all pairs.

Defined cases: null, empty and white-space texts have empty sets and stand alone; texts
shorter than a shingle are one shingle; rows that repeat a ``doc_id`` are judged each by its
own text and share their id's place in the result; a null ``doc_id`` never names a component
that has another id. Other columns never matter to ``near_duplicates``. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, row_mark, stored, text_or_empty
from tidemark.llm.components import components

ROWS = 4          # coordinates per band
MISS = 1e-7
BLOCK = 512       # classes per side that a task compares at once
BROADCAST_ROWS = 1_000_000  # ids of at most 24 bytes: 24 MB
REMEMBERED = 400_000

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SIGMA = np.uint32(0x9E3779B1)
_MIX = np.uint32(0x7FEB352D), np.uint32(0x846CA68B)


def bands_for(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold ** ROWS))


def least_agreement(threshold: float) -> float:
    """Share of coordinates that a pair at the threshold falls short of with ``MISS``."""
    count = bands_for(threshold) * ROWS
    return threshold - 5.2 * math.sqrt(threshold * (1 - threshold) / count)


class Codes(dict):
    """64-bit codes of words."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        code = xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = code
        return code


def shingles(text: bytes, size: int, codes: Codes) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles. ``lower`` changes A-Z only."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    found = np.full(count, width, np.uint64)
    for i in range(width):
        found ^= hashed[i:i + count]
        found *= _PRIME
        found ^= found >> np.uint64(32)
    return np.unique(found)


def signature(hashes: np.ndarray, count: int) -> np.ndarray:
    """Coordinates 0 .. count-1: least value of the shifted second permutation."""
    spread = (hashes >> np.uint64(32)).astype(np.uint32) * _SIGMA  # first permutation
    shifts = np.arange(count, dtype=np.uint32)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(spread), 256):
        y = spread[i:i + 256, None] + shifts
        y ^= y >> np.uint32(16)
        y *= _MIX[0]
        y ^= y >> np.uint32(15)
        y *= _MIX[1]
        np.minimum(least, y.min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(-1, ROWS).astype(np.uint64)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64) * _PRIME
    for i in range(ROWS):
        keys = (keys ^ rows[:, i]) * _PRIME
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def set_id(hashes: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(hashes.tobytes())


def sketches(docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """``(doc_id, n_shingles, set_id, bands, coordinates)`` of every row."""
    bands = bands_for(threshold)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            counts, names, keys, marks = [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                hashes = shingles(text.as_py() or b"", size, codes)
                counts.append(len(hashes))
                if not len(hashes):
                    names.append(None)
                    keys.append(None)
                    marks.append(None)
                    continue
                found = signature(hashes, bands * ROWS)
                names.append(set_id(hashes))
                keys.append(band_keys(found))
                marks.append(found.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["doc_id", "n_shingles", "set_id", "bands", "coordinates"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        sketch, f"doc_id {kind}, n_shingles bigint, set_id binary, bands array<bigint>, "
                "coordinates binary")


def sets_of(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """``(set_id, hashes)`` of the classes in ``needed`` (``set_id``, ``least``)."""
    def recompute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            rows = []
            for wanted, text in zip(batch.column(0).to_pylist(),
                                    batch.column(1).cast(pa.binary()).to_pylist()):
                hashes = shingles(text or b"", size, codes)
                if set_id(hashes) == wanted:
                    rows.append((wanted, hashes.tobytes()))
            names, sets = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(sets, pa.binary())], ["set_id", "hashes"])

    texts = docs.select("doc_id", "text").join(
        small(needed), F.col("doc_id").eqNullSafe(F.col("least"))).select("set_id", "text")
    return texts.mapInArrow(recompute, "set_id binary, hashes binary")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows with equal first three columns, which stand together."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != key:
                if rows:
                    yield rows
                key, rows = row[:3], []
            rows.append(row[3:])
    if rows:
        yield rows


def forest(pairs: Iterator[tuple[int, int]], count: int) -> Iterator[tuple[int, int]]:
    """Pairs that connect what the pairs before them have not."""
    parent = list(range(count))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            parent[a] = b
            yield i, j


def agreeing(left: list[bytes], right: list[bytes], threshold: float) -> np.ndarray:
    """Which signatures agree often enough."""
    a, b = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1) for x in (left, right))
    least = least_agreement(threshold) * a.shape[1]
    return np.stack([(row == b).sum(axis=1) for row in a]) >= least


def similar(left: list[bytes], right: list[bytes], percent: int) -> np.ndarray:
    """Which sets have ``100 * intersection >= percent * union``, exactly."""
    a, b = ([np.frombuffer(x, np.uint64) for x in side] for side in (left, right))
    sizes = np.add.outer([len(x) for x in a], [len(x) for x in b])
    shared = np.zeros(sizes.shape, np.int64)
    if sizes.size <= 4:
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                shared[i, j] = len(np.intersect1d(x, y, assume_unique=True))
    else:
        mine, yours = (np.unique(np.concatenate(side)) for side in (a, b))
        common = np.intersect1d(mine, yours, assume_unique=True)
        for i in range(0, len(common), 4096):
            part = common[i:i + 4096]
            x, y = (np.stack([np.isin(part, s, assume_unique=True) for s in side]).astype(np.float32)
                    for side in (a, b))
            shared += (x @ y.T).astype(np.int64)
    return 100 * shared >= percent * (sizes - shared)


def compared(tasks: DataFrame, payload: DataFrame, column: str, test) -> DataFrame:
    """Links ``(a, b)`` between the two sides of each task that pass ``test``.

    ``tasks``: (group, block, slice, set_id, root, side), side 0 left, 1 right, 2 both.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches):
            left = [r for r in rows if r[2] != 1]
            right = [r for r in rows if r[2] != 0]
            if not left or not right or len({r[1] for r in rows}) < 2:
                continue
            passed = test([r[3] for r in left], [r[3] for r in right])
            names = list({r[0] for r in rows})
            place = {name: i for i, name in enumerate(names)}
            pairs = ((place[left[i][0]], place[right[j][0]]) for i, j in np.argwhere(passed)
                     if left[i][1] != right[j][1])
            found = list(forest(pairs, len(names)))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i, _ in found], pa.binary()),
                     pa.array([names[j] for _, j in found], pa.binary())], ["a", "b"])

    keys = ["group", "block", "slice"]
    rows = tasks.join(payload, "set_id").select(*keys, "set_id", "root", "side", column)
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        compare, "a binary, b binary")


def as_tasks(rows: DataFrame, count: int) -> DataFrame:
    """Tasks that together compare all of a group's rows of different ``root``.

    A group of at most ``BLOCK`` rows is one task. In a larger one, the rows outside its
    most frequent root meet all rows, block by block: rows of that root alone never need to.
    """
    counts = stored(rows.groupBy("group", "root").agg(F.count("*").alias("rows")), count)
    groups = counts.groupBy("group").agg(
        F.sum("rows").alias("total"), F.max("rows").alias("most"),
        F.max_by("root", "rows").alias("main")).where("total > most")
    sized = rows.join(stored(groups, count), "group").select(
        "*", F.ceil((F.col("total") - F.col("most")) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("total") / BLOCK).cast("int").alias("slices"))
    place = F.pmod(F.xxhash64("set_id"), F.lit(1 << 30))

    def task(df: DataFrame, block, slice_, side: int) -> DataFrame:
        return df.select("group", block.cast("int").alias("block"), slice_.cast("int").alias("slice"),
                         "set_id", "root", F.lit(side).alias("side"))

    def each(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    large = sized.where(F.col("total") > BLOCK)
    outside = large.where(F.col("root") != F.col("main")).withColumn("slice", each("slices"))
    inside = large.withColumn("block", each("blocks"))
    parts = [
        task(sized.where(F.col("total") <= BLOCK), F.lit(0), F.lit(0), 2),
        task(outside, F.pmod(place, "blocks"), F.col("slice"), 0),
        task(inside, F.col("block"), F.pmod(F.floor(place / 1024), "slices"), 1),
    ]
    return reduce(DataFrame.unionAll, parts)


def star_tasks(stars: DataFrame, count: int) -> DataFrame:
    """Tasks that compare each ``b`` with its hub ``a``."""
    slices = F.ceil(F.count("*") / BLOCK).cast("int")
    hubs = stored(stars.groupBy("a").agg(slices.alias("slices")), count)
    place = F.pmod(F.xxhash64("b"), F.lit(1 << 30))
    zero = F.lit(0).alias("block")
    left = hubs.select(F.col("a").alias("group"), zero,
                       F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
                       F.col("a").alias("set_id"), F.col("a").alias("root"), F.lit(0).alias("side"))
    right = stars.join(hubs, "a").select(
        F.col("a").alias("group"), zero, F.pmod(place, "slices").cast("int").alias("slice"),
        F.col("b").alias("set_id"), F.col("b").alias("root"), F.lit(1).alias("side"))
    return left.unionAll(right)


def links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` of classes that connect what belongs together."""
    threshold, count = percent / 100, classes.count()
    keys = classes.select("set_id", F.explode("bands").alias("group"))
    buckets = stored(
        keys.groupBy("group").agg(F.count("*").alias("size"), F.min("set_id").alias("hub"))
        .where("size > 1"), count * bands_for(threshold))
    members = stored(keys.join(buckets, "group"), count * bands_for(threshold))
    many = members.count()

    def exact(tasks: DataFrame) -> DataFrame:
        tasks = stored(tasks, many)
        if tasks.isEmpty():
            return tasks.select(F.col("set_id").alias("a"), F.col("set_id").alias("b"))
        needed = classes.select("set_id", "least").join(
            tasks.select("set_id").distinct(), "set_id", "left_semi")
        sets = stored(sets_of(docs, stored(needed, count), size))
        return stored(compared(tasks, sets, "hashes", lambda a, b: similar(a, b, percent)))

    stars = stored(members.where((F.col("size") > BLOCK) & (F.col("set_id") != F.col("hub")))
                   .select(F.col("hub").alias("a"), F.col("set_id").alias("b")).distinct(), many)
    found = exact(star_tasks(stars, count))
    roots = stored(components(found, count), count)

    def rooted(rows: DataFrame) -> DataFrame:
        return rows.join(roots, F.col("set_id") == F.col("node"), "left").select(
            "group", "set_id", F.coalesce("root", "set_id").alias("root"))

    marks = classes.select("set_id", "coordinates")
    tasks = as_tasks(stored(rooted(members), many), many)
    maybe = stored(compared(tasks, marks, "coordinates",
                            lambda a, b: agreeing(a, b, threshold)))
    clusters = components(maybe, count).select(
        F.col("node").alias("set_id"), F.col("root").alias("group"))
    clusters = stored(rooted(stored(clusters, count)), count)
    return found.unionAll(exact(as_tasks(clusters, count)))


def labelled(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, set_id, root, component_id)`` of every row; components have
    one root each, and may share an id where rows repeat it."""
    drawn = stored(sketches(docs, size, percent / 100))
    classes = stored(
        drawn.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
            F.min("doc_id").alias("least"), F.first("bands").alias("bands"),
            F.first("coordinates").alias("coordinates")))
    count = classes.count()
    roots = stored(components(links(docs, classes, size, percent), count), count)
    grouped = stored(
        classes.select("set_id", "least").join(roots, F.col("set_id") == F.col("node"), "left")
        .select("set_id", "least", F.coalesce("root", "set_id").alias("root")), count)
    names = stored(grouped.groupBy("root").agg(F.min("least").alias("component_id")), count)
    by_set = stored(grouped.join(names, "root").select(
        F.col("set_id").alias("of_set"), "root", "component_id"), count)
    return drawn.join(by_set, F.col("set_id") == F.col("of_set"), "left").select(
        "doc_id", "n_shingles", "set_id", "root",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row."""
    return labelled(docs, size, percent).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The row with the smallest ``doc_id`` of each group, with all columns of ``docs``.

    Documents without words are no one's copies and stay. Where several rows have that
    ``doc_id``, those of the group are told apart by a hash of all their columns.
    """
    @F.pandas_udf("binary")
    def set_of(texts: pd.Series) -> pd.Series:
        codes = Codes()
        return pd.Series([set_id(shingles((t or "").encode(), size, codes)) for t in texts])

    marks = stored(labelled(docs, size, percent).where(F.col("set_id").isNotNull()).select(
        "doc_id", "set_id", "root",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("named")))
    ids = marks.groupBy(F.col("doc_id").alias("of_id")).agg(
        F.count("*").alias("rows"), F.max("named").alias("named"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.col("text"))
    wordless = rows.where(~text_or_empty().rlike(WORD))
    worded = rows.where(text_or_empty().rlike(WORD))
    same = F.col("doc_id").eqNullSafe(F.col("of_id"))
    # Ids that go, and those of several rows: fewer than the ids that stay.
    others = stored(ids.where(~F.col("named") | (F.col("rows") > 1)))
    found = worded.join(small(others.select("of_id")), same, "left_anti").select("row")
    repeated = others.where("named")
    if not repeated.isEmpty():
        sets = marks.where("named").groupBy("doc_id", "root").agg(F.min("set_id").alias("kept_set"))
        sets = sets.select(F.col("doc_id").alias("set_of_id"), "kept_set")
        several = worded.join(small(repeated.select("of_id")), same, "left_semi").withColumn(
            "of_set", set_of("text"))
        of_group = several.join(sets, F.col("doc_id").eqNullSafe(F.col("set_of_id"))
                                & (F.col("of_set") == F.col("kept_set")))
        found = found.unionAll(
            of_group.withColumn("mark", row_mark(["row"])).groupBy("doc_id", "of_set").agg(
                F.min_by("row", "mark").alias("row")).select("row"))
    return found.unionAll(wordless.select("row")).select("row.*")


def small(df: DataFrame) -> DataFrame:
    """``df``, a table of ids, to be broadcast where it is small enough."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
