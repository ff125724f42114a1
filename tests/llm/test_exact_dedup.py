from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, SCHEMA, clashing, documents
from tidemark.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    for body, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            yield i, keep, len(ids), i == keep, hashlib.sha256(body.encode()).hexdigest()


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda body: F.lit("one for all")])
def test_groups(spark, digest):
    """Also where every text has the same digest: contents decide."""
    found = exact_dedup.duplicates(clashing(documents(spark, ODD)), salts=3, digest=digest)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected(ODD), key=repr)


def test_one_row_per_group_stays(spark):
    docs = clashing(documents(spark, ODD))
    kept = exact_dedup.deduplicated(docs, salts=3)
    assert kept.columns == docs.columns
    bodies = {(k, s) for i, k, _, _, s in expected(ODD)}
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(k) for k, _ in bodies)


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicates(empty).count() == exact_dedup.deduplicated(empty).count() == 0
