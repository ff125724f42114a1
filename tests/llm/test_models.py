from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, SCHEMA, clashing, documents, prose
from tidemark.llm import licenses, quality
from tidemark.llm.common import stored

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def drawn(docs, labels, **options):
    return quality.drawn(stored(quality.scored(docs, labels, **options)), labels)


def test_held_out_labels(spark):
    """Fitted on half of the labels, the draw tells the other half apart."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    found = drawn(docs, labels.where(half)).select("row.doc_id", "selected").join(
        labels.where(~half), "doc_id").collect()
    right = sum(r.selected == bool(r.quality) for r in found)
    assert len(found) > 100 and right >= 0.99 * len(found)


def test_draw_against_brute_force(spark):
    rows = [(i, prose(i, 30)) for i in range(40)] + [(100 + i, "buy!!! now!!! " * 20) for i in range(9)]
    rows += ODD
    labels = [(i, 1, 0) for i in range(30)] + [(None, 1, 0), (5, None, 0), (9, 0, 0)]
    labels += [(100 + i, 0, 1) for i in range(4)] + [(104, None, 1), (999, 0, 0)]
    docs = clashing(documents(spark, rows))
    found = drawn(docs, spark.createDataFrame(labels, LABELS)).collect()
    hashes, raw, target = quality.Hashes(), np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for doc_id, text in rows:
        for b in quality.ngram_buckets(text, hashes):
            raw[b] += 1
            target[b] += doc_id is not None and doc_id in range(30)
    expected = raw * target.sum() / raw.sum()
    ratios = np.log((target + quality.PRIOR) / (expected + quality.PRIOR))
    weights = {}
    for doc_id, text in rows:
        b = quality.ngram_buckets(text, hashes)
        weights[doc_id, text] = ratios[b].sum() / (len(b) + quality.SHORT)
    assert all(abs(weights[r.row.doc_id, r.row.text] - r.log_weight) < 1e-9 for r in found)
    known = [(weights[row], row[0] < 30) for row in rows
             if row[0] is not None and (row[0] in range(30) or 100 <= row[0] < 104)]
    slope, start = quality.logistic(*(np.array(x, float) for x in zip(*known)))
    k = round(sum(1 / (1 + np.exp(-slope * weights[row] - start)) for row in rows))
    least = sorted((r.score for r in found), reverse=True)[k - 1]
    assert {r.selected for r in found if r.score >= least} == {True}
    assert not any(r.selected for r in found if r.score < least)
    assert not any(r.selected for r in found if (r.row.doc_id or 0) >= 100)


def test_logistic_solves_its_equations():
    rng = np.random.default_rng(3)
    for weights, good in (
            (rng.normal(size=500), None),
            (np.concatenate([np.full(9, -0.8), np.full(30, 0.03)]), np.arange(39) >= 9),
            (np.linspace(-1, 1, 40), np.arange(40) >= 17),
            (np.zeros(10), np.arange(10) < 3)):
        if good is None:
            good = rng.random(500) < 1 / (1 + np.exp(2 - 3 * weights))
        slope, start = quality.logistic(weights, good.astype(float))
        chance = 1 / (1 + np.exp(-slope * weights - start))
        assert abs(chance.sum() - good.sum()) < 1e-6  # as many good ones as there are
        assert abs(weights @ (chance - good) + quality.RIDGE * slope) < 1e-6


def test_draws_follow_the_weights(spark):
    """Documents near the border come and go with the seed, as often as draws one by one by
    weight would take them; a share given is the share drawn."""
    count, k, seeds = 60, 20, 400
    weights = np.linspace(-0.03, 0.03, count)
    rows = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)],
                                 "id bigint, log_weight double")
    scores = rows.select("id", "log_weight", F.explode(F.sequence(F.lit(1), F.lit(seeds)))
                         .alias("seed")).withColumn("noise", quality.gumbel(F.col("seed"), F.col("id")))
    found = scores.select("seed", "id", quality.score().alias("score")).toPandas()
    best = found.sort_values("score", ascending=False).groupby("seed").head(k)
    often = best["id"].value_counts().reindex(range(count), fill_value=0).to_numpy() / seeds
    rng, want = np.random.default_rng(5), np.zeros(count)
    chance = np.exp(weights * quality.SCALE)
    for _ in range(4000):
        want[rng.choice(count, k, replace=False, p=chance / chance.sum())] += 1 / 4000
    assert np.abs(often - want).max() < 0.1 and np.abs(often - want).mean() < 0.025
    assert ((often > 0.05) & (often < 0.95)).sum() > count / 2
    one = stored(scores.where("seed = 7").select("id", "log_weight", quality.score().alias("score")))
    drawn_ids = {r.id for r in quality.drawn(one, None, share=1 / 3).where("selected").collect()}
    assert drawn_ids == set(best[best["seed"] == 7]["id"])
    assert quality.drawn(one, None, share=0).where("selected").count() == 0


def test_nothing_to_go_by(spark):
    docs = documents(spark, ODD)
    assert drawn(docs, spark.createDataFrame([], LABELS)).where("selected").count() == len(ODD)
    empty = spark.createDataFrame([], SCHEMA)
    assert drawn(empty, spark.createDataFrame([], LABELS)).count() == 0


def test_kth_largest(spark):
    values = [float(x) for x in [3, 3, 1, 7, 7, 7, -2, 1e9, 0.1, 0.1 + 1e-12]]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for k, want in enumerate(sorted(values, reverse=True), 1):
        assert quality.kth_largest(rows, "v", k) == want


def test_notices(spark):
    """Planted notices are found, licences that don't exist are not."""
    rows = list(ODD)
    want = set()
    for i in range(300):
        rows.append((1000 + i, prose(i, 60) + "\n" + prose(i + 1, 5)))
    for i, (family, notice) in enumerate((f, n) for f in licenses.FAMILIES
                                         for n in licenses.notices(f)):
        rows.append((2000 + i, f"{prose(i, 40)}\n{notice} {prose(i, 50)}\n{prose(i, 9)}"))
        want.add((2000 + i, 1, family))
    rows.append((5000, "Licensed under the Quibble License, version 7.\nThe licence plate of a car."))
    found = licenses.scanned(clashing(documents(spark, rows))).collect()
    got = {(r.doc_id, r.paragraph, r.family) for r in found}
    assert not got - want
    assert len(got & want) >= 0.95 * len(want)
    assert all(0.5 <= r.probability <= 1 and r.similarity >= licenses.CONFIRMED for r in found)
    assert licenses.scanned(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bound_never_hides_a_window():
    model = licenses.Model([prose(i, 24) for i in range(200)])
    hashes = licenses.Hashes()
    for text in [f"{prose(i, 10)} {n}" for i, n in enumerate(licenses.notices("MIT"))]:
        words = np.array([hashes[t] for t in licenses.tokens(text)], np.uint64)
        begin = np.arange(len(words))
        end = np.minimum(begin + licenses.WINDOW, len(words))
        kept = set(model.possible(begin, end, licenses.ngrams(words)).tolist())
        for i, j in zip(begin, end):
            logits = model._logits([licenses.features(words[i:j])])[0]
            if logits[:-1].max() > logits[-1]:
                assert int(i) in kept


# Wordings that the model was not built from.
UNSEEN = [
    ("Distributed under the MIT License.", {(0, "MIT")}),
    ("The plugin is available under the MIT License", {(0, "MIT")}),
    ("Everything in here uses the MIT license", {(0, "MIT")}),
    ("You may copy it under the conditions of the ISC license.", {(0, "ISC")}),
    ("governed by the three-clause BSD licence", {(0, "BSD-3-Clause")}),
    ("see the Mozilla Public License, v. 2.0 for details", {(0, "MPL-2.0")}),
    ("Licensed under the MIT License or the Apache License, Version 2.0.",
     {(0, "MIT"), (0, "Apache-2.0")}),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause",
     {(0, "MIT"), (0, "Apache-2.0"), (0, "BSD-3-Clause")}),
    ("dual licensed, GPLv2 and GPLv3", {(0, "GPL-2.0"), (0, "GPL-3.0")}),
    ("# Licensed under the Apache\n# License, Version 2.0", {(0, "Apache-2.0")}),
    (" * it under the terms of the GNU General Public License as published by\n"
     " * the Free Software Foundation, either version 3 of the License, or\n"
     " * (at your option) any later version.", {(0, "GPL-3.0")}),
    (" * modify it under the terms of the GNU Lesser General Public\n"
     " * License as published by the Free Software Foundation; either\n"
     " * version 3 of the License.", {(0, "LGPL-3.0")}),
    ("Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this "
     "library", {(0, "MIT")}),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are "
     "permitted provided that the following conditions are met:\n\n1. Source must retain the "
     "notice.\n\n3. Neither the name of Foo nor its contributors may be used to endorse or\n"
     "promote products derived from this software without permission.",
     {(0, "BSD-3-Clause"), (5, "BSD-3-Clause")}),
    ("Use of this is under the MIT\n\nLicense plates are sold here.", set()),
    ("Licensed under the Apache License, Version 1.1", set()),
    ("GNU Lesser General Public License version 2.1", set()),
]


def test_unseen_wordings():
    model, hashes = licenses.Model([prose(i, 14) for i in range(2000)]), licenses.Hashes()
    for text, want in UNSEEN:
        for rest in ("", f"\n\n{prose(1, 70)}\n{prose(2, 9)}"):
            assert {(p, f) for p, f, _, _ in model.scan(text + rest, hashes)} == want, text
