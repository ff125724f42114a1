"""Training-order materialisation.

Documents' ids are cut into sequences of fixed length within each task. Sequences have
consecutive numbers over all tasks, and a keyed permutation gives each one its slot in
training order: a balanced Feistel network over the smallest square power of two that holds
them all, walked along its cycle until the slot is inside the range. Every slot is taken
once, and no table of slots exists.

Slots are dealt out by ranges of ``run`` shards; a range is sorted and written as shards of a fixed number
of sequences with a fixed stride, so slot ``s`` lies in shard ``s // SHARD`` at byte
``(s % SHARD) * stride``. A reader that stops at a slot goes on there by one seek.

A first pass counts tokens, a second one encodes; what passes between them is one number
per task, so ids are shuffled once and stored once, in the shards. Both passes must see the
same rows in the same tasks, as a table's files give them; this is checked at the end.

Defined cases: a null text is empty, and an empty document is its end id alone. Rows that
repeat a ``doc_id`` are documents of their own. The last sequence of a task is filled up with
``PAD``; ``n_tokens`` tells how much of it counts. Other columns never matter. An empty table
gives no shards.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.files import Output, Ranges, locate
from tidemark.llm.tokens import encoder, largest_id

LENGTH = 2048     # tokens per sequence
SHARD = 8192      # sequences per shard
RUN = 1           # consecutive shards that one task sorts and writes
END_ID = 50256
PAD = 50256
ROUNDS = 6
FLUSH = 4 << 20   # bytes of ids per batch that leaves a task


def id_type(tokenizer: str) -> str:
    """The narrowest type that holds all ids of the vocabulary, and those put in here."""
    return "<u2" if max(largest_id(tokenizer), END_ID, PAD) < 1 << 16 else "<u4"


def mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A hash of 64-bit values."""
    x = values + np.uint64(key)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Permutation:
    """A keyed permutation of 0 .. count-1, and its inverse."""

    def __init__(self, count: int, key: int):
        self.count = count
        self.half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [int(k) for k in np.random.default_rng(key).integers(0, 1 << 63, ROUNDS)]

    def _walk(self, values, once) -> np.ndarray:
        found = once(np.asarray(values, np.uint64))
        while (outside := found >= np.uint64(self.count)).any():
            found[outside] = once(found[outside])
        return found.astype(np.int64)

    def _forward(self, values: np.ndarray) -> np.ndarray:
        left, right = values >> self.half, values & self.mask
        for key in self.keys:
            left, right = right, left ^ mixed(right, key) & self.mask
        return left << self.half | right

    def _backward(self, values: np.ndarray) -> np.ndarray:
        left, right = values >> self.half, values & self.mask
        for key in reversed(self.keys):
            left, right = right ^ mixed(left, key) & self.mask, left
        return left << self.half | right

    def slots(self, numbers) -> np.ndarray:
        return self._walk(numbers, self._forward)

    def numbers(self, slots) -> np.ndarray:
        return self._walk(slots, self._backward)


def token_totals(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(part, sequences)``: sequences that each task of the second pass will have."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = encoder(tokenizer, id_type(tokenizer)), 0
        for batch in batches:
            total += sum(encode.count(t) + 1 for t in batch.column(0).to_pylist())
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()),
                 pa.array([-(-total // LENGTH)], pa.int64())], ["part", "sequences"])

    return stored(docs.select("text").mapInArrow(count, "part int, sequences bigint"))


def sequences(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(part, place, doc_ids, n_tokens, ids)``; ``place`` counts a task's sequences."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, names = np.dtype(id_type(tokenizer)), None
        encode, part = encoder(tokenizer, dtype.str), TaskContext.get().partitionId()
        rows: list[tuple] = []
        held, members, filled, place = [], [], 0, 0

        def batch() -> pa.RecordBatch:
            places, docs_, counts, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), pa.array(places, pa.int64()),
                 pa.array(docs_, pa.list_(names)), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.binary())],
                ["part", "place", "doc_ids", "n_tokens", "ids"])

        for taken in batches:
            names = taken.schema.field(0).type
            for doc_id, text in zip(*(c.to_pylist() for c in taken.columns)):
                ids = np.append(encode.array(text), dtype.type(END_ID))
                while len(ids):
                    piece, ids = ids[:LENGTH - filled], ids[LENGTH - filled:]
                    held.append(piece)
                    members.append(doc_id)
                    filled += len(piece)
                    if filled == LENGTH:
                        rows.append((place, members, LENGTH, np.concatenate(held).tobytes()))
                        held, members, filled, place = [], [], 0, place + 1
                        if len(rows) * LENGTH * dtype.itemsize >= FLUSH:
                            yield batch()
                            rows.clear()
        if filled:
            held.append(np.full(LENGTH - filled, PAD, dtype))
            rows.append((place, members, filled, np.concatenate(held).tobytes()))
        if rows:
            yield batch()

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"part int, place bigint, doc_ids array<{kind}>, n_tokens bigint, ids binary")


def materialised(docs: DataFrame, tokenizer: str, folder: str, key: int = 1,
                 run: int = RUN) -> DataFrame:
    """Write the shards; ``(slot, sequence, shard, offset, doc_ids, n_tokens, ids_crc32)``.

    ``folder`` also gets ``layout.json`` with what a reader needs. ``run`` consecutive shards are
    one task's: more make fewer tasks, and need more memory in each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    totals = token_totals(docs, tokenizer)
    count = totals.agg(F.sum("sequences")).first()[0] or 0
    before = F.sum("sequences").over(Window.orderBy("part")) - F.col("sequences")
    starts = stored(totals.select(F.col("part"), before.alias("before")))  # one row per task
    dtype = id_type(tokenizer)
    order, stride = Permutation(count, key), LENGTH * np.dtype(dtype).itemsize

    @F.pandas_udf("bigint")
    def slot_of(numbers):
        import pandas as pd

        return pd.Series(order.slots(numbers.to_numpy()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = None, None
        for batch in batches:
            for shard, ids in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
                if shard != current:
                    if out is not None:
                        out.close()
                    out, current = Output(folder, shard_name(shard)), shard
                out.write(ids)
            yield batch.select(["slot", "sequence", "shard", "doc_ids", "n_tokens", "crc"])
        if out is not None:
            out.close()

    tasks = -(-count // (SHARD * run)) or 1
    placed = (
        sequences(docs, tokenizer).join(starts, "part")
        .withColumn("sequence", F.col("before") + F.col("place"))
        .withColumn("slot", slot_of("sequence"))
        .select("slot", "sequence", F.floor(F.col("slot") / SHARD).alias("shard"), "doc_ids",
                "n_tokens", F.crc32("ids").alias("crc"), "ids")
        .repartitionById(tasks, F.floor(F.col("shard") / run).cast("int"))
        .sortWithinPartitions("slot")
    )
    written = stored(placed.mapInArrow(
        write, f"slot bigint, sequence bigint, shard bigint, doc_ids array<{kind}>, "
               "n_tokens bigint, crc bigint"))
    total = F.sum(F.col("slot").cast("decimal(38,0)"))  # beyond a long from 4.3e9 slots on
    taken = written.agg(F.count("*"), F.max("slot"), total).first()
    if count and tuple(taken) != (count, count - 1, count * (count - 1) // 2):
        raise ValueError("the two passes saw different rows; store the documents first")
    system, path = locate(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/layout.json") as file:
        file.write(json.dumps({"sequences": count, "length": LENGTH, "dtype": dtype,
                               "shard": SHARD, "key": key}).encode())
    return written.select(
        "slot", "sequence", "shard", (F.pmod("slot", F.lit(SHARD)) * stride).alias("offset"),
        "doc_ids", "n_tokens", F.col("crc").alias("ids_crc32"))


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def read_from(folder: str, slot: int = 0, stop: int | None = None) -> Iterator[np.ndarray]:
    """Sequences in training order from ``slot`` on."""
    system, path = locate(folder)
    with system.open_input_stream(f"{path}/layout.json") as file:
        layout = json.loads(file.read())
    dtype, files = np.dtype(layout["dtype"]), Ranges(folder)
    stride = layout["length"] * dtype.itemsize
    for at in range(slot, layout["sequences"] if stop is None else stop):
        shard, place = divmod(at, layout["shard"])
        yield np.frombuffer(files.read(shard_name(shard), place * stride, stride), dtype)
