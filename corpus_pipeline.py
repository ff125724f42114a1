"""The corpus pipeline: quality, exact and near duplicates, mixing, packing.

A stage's result must be written before the next stage begins, as ``run`` does: each stage
first deletes what the stages before it have kept in the scratch folder, but for what its own
documents are still read from.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, mixing, near_dedup, packing, quality
from tidemark.llm.common import collecting, delete, read_paths, stored, table
from tidemark.llm.queries import BPE, vocabulary_path


_KEPT: list[str] = []  # scratch folders of the stages so far


def stage(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @wraps(function)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        needed = read_paths(docs)
        done = [p for p in _KEPT if urlparse(p).path not in needed]
        delete(spark, done)
        _KEPT[:] = [p for p in _KEPT if p not in done]
        with collecting(_KEPT):
            return function(spark, docs, sf_dir)
    return begun


@stage
def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their importance weight; what looks unlike the target goes."""
    labels = table(spark, sf_dir, "labels")
    rows = stored(quality.scored(docs, labels))
    return quality.drawn(rows, labels).where("selected").select("row.*")


@stage
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return near_dedup.deduplicated(docs, size=5, percent=80)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their weights."""
    return mixing.mixed(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in fixed windows of token ids."""
    return packing.with_checksums(packing.packed(docs, vocabulary_path(BPE)))


STAGES = [
    ("quality", good_text),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]
ORACLE_SQL = None  # hashed models, sketches and tokenizers can't be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        result = apply(spark, docs, sf_dir)
        with collecting(_KEPT):
            docs = stored(result)
    return STAGES[-1][1](spark, docs, sf_dir)
