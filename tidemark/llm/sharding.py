"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards carries a weight on each shard; a rack or a region weighs
what its shards weigh together. A document descends from the root: at each level every child
draws ``-ln(u) / weight``, with ``u`` a hash of the document's id and the child's path, and
the least draw is taken. So the id and the tree alone decide, no table of places exists, and
a child gets its weight's share of the rows.

A draw depends on nothing but the id, the child and the child's weight. Where a weight
changes, rows move only into or out of the subtrees that hold it: of two regions none of
whose weights changed, neither gives a row to the other, and the same holds for racks within
a region and shards within a rack. ``grown`` adds a shard as a region of its own, so every
row that moves, moves into the new shard. A shard added inside a rack also draws rows into the
other shards of its region, whose weight rises.

``written`` sorts the documents by shard and id, over ranges of about equal size, and writes
each shard as a folder of files. A row's slot is its place in its shard: the rows of the files
before its own, and its place in the file.

Defined cases: rows that repeat an id share a shard, also as nulls do, and lie next to each
other, in the order of their sizes and checksums; a null text is empty. Shards of weight 0
get no rows. Other columns are written and read back whatever their names. An empty table
gives no files and no rows. A tree without weight is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_or_empty
from tidemark.session import scratch_dir

SEED = 53
BROADCAST_FILES = 1_000_000  # rows of three numbers each
Tree = dict[str, dict[str, dict[int, float]]]


def balanced(regions: int, racks: int, shards: int) -> Tree:
    """Equal weights; shards are numbered in the order of racks and regions."""
    return {f"region{g}": {f"rack{r}": {(g * racks + r) * shards + s: 1.0 for s in range(shards)}
                           for r in range(racks)} for g in range(regions)}


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """``tree`` and one more shard, in a region of its own."""
    number = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return tree | {f"region-of-{number}": {"rack0": {number: weight}}}


def children(tree: Tree) -> dict[str, list[tuple[str, float]]]:
    """Names and weights of the children of each inner node, by the node's path."""
    found: dict[str, list[tuple[str, float]]] = {"": []}
    for region, racks in tree.items():
        for rack, shards in racks.items():
            if min(shards.values(), default=0) < 0:
                raise ValueError("a weight is negative")
            found[f"/{region}/{rack}"] = [(str(s), float(w)) for s, w in shards.items() if w]
        found[f"/{region}"] = [
            (rack, weight) for rack in racks
            if (weight := sum(w for _, w in found[f"/{region}/{rack}"]))]
        weight = sum(w for _, w in found[f"/{region}"])
        if weight:
            found[""].append((region, weight))
    if not found[""]:
        raise ValueError("the tree has no weight")
    return {path: nodes for path, nodes in found.items() if nodes}


def draw(key: Column, path: Column, weight: Column, seed: int) -> Column:
    """An exponential draw of rate ``weight``: 52 bits of a digest, never 0 or 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key, path))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(2.0 ** 52)) / weight


def shard_of(tree: Tree, key: Column, seed: int = SEED) -> Column:
    """The shard of the document with the id ``key``."""
    by_path = children(tree)
    key = F.coalesce(key.cast("string"), F.lit("null"))
    nodes = F.create_map(*(part for path, found in by_path.items() for part in (
        F.lit(path), F.array(*(F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"))
                               for name, weight in found)))))

    def below(path: Column) -> Column:
        drawn = F.transform(F.element_at(nodes, path), lambda node: F.struct(
            draw(key, F.concat(path, F.lit("/"), node["name"]), node["weight"], seed),
            node["name"].alias("name")))
        return F.concat(path, F.lit("/"), F.array_min(drawn)["name"])

    path = F.array(F.lit(""))
    for _ in range(3):  # as the only element of an array, a path is computed once
        path = F.transform(path, below)
    return F.element_at(F.split(path[0], "/"), -1).cast("int")


def sizes() -> tuple[Column, Column]:
    """Bytes of a text plus one, and the CRC-32 of the text."""
    return (F.octet_length(text_or_empty()).cast("bigint") + 1,
            F.crc32(text_or_empty().cast("binary")))


def written(docs: DataFrame, tree: Tree, folder: str, seed: int = SEED) -> DataFrame:
    """Write the shards to ``folder/shard=n``; ``(row, shard, slot)`` as read from there."""
    size, checksum = sizes()
    order = [F.col("shard"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("checksum"),
             F.col("spread")]
    placed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id"), shard_of(tree, F.col("doc_id"), seed)
        .alias("shard"), size.alias("size"), checksum.alias("checksum"),
        F.monotonically_increasing_id().alias("spread"))  # an id of many rows fills many ranges
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "shard")
    ranged.write.partitionBy("shard").parquet(folder)
    return read(docs, folder)


def read(docs: DataFrame, folder: str) -> DataFrame:
    """``(row, shard, slot)`` of shards written from a table like ``docs``."""
    schema = docs.select(F.struct("*").alias("row"), F.lit(0).alias("shard")).schema
    name = F.col("_metadata.file_name")
    rows = docs.sparkSession.read.schema(schema).parquet(folder).select(
        "row", "shard", F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("task"),
        F.regexp_extract(name, r"c(\d+)\.[a-z.]*parquet$", 1).cast("int").alias("file"),
        F.col("_metadata.row_index").alias("place"))
    files = stored(rows.groupBy("shard", "task", "file").agg((F.max("place") + 1).alias("rows")))
    before = Window.partitionBy("shard").orderBy("task", "file")
    starts = stored(files.select("shard", "task", "file",
                                 (F.sum("rows").over(before) - F.col("rows")).alias("start")))
    if starts.count() <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    return rows.join(starts, ["shard", "task", "file"]).select(
        "row", "shard", (F.col("start") + F.col("place")).alias("slot"))


def digested(docs: DataFrame, tree: Tree, seed: int = SEED) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of the written shards."""
    rows = written(docs, tree, f"{scratch_dir(docs.sparkSession)}/shards", seed).select(
        "row.doc_id", "row.text", "shard", "slot")
    size, checksum = sizes()
    return rows.select(
        "doc_id", size.alias("size"), checksum.alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "slot", shard_of(grown(tree), F.col("doc_id"), seed).alias("grown_shard"))
