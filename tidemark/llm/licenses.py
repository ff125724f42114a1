"""Licence notices in documents.

Paragraphs are lines without a blank line (one that has no word) between them. Words of a
paragraph follow each other across its line breaks. A notice needs two things:

- a mark: the part of a notice that only its family has, in the words it is made of. Marks
  are names with their version (``names``), identifiers (alone where nothing else is called
  so, and each one of an SPDX expression), and phrases of the families' grants, of which
  ``CONFIRMED`` must be held. A mark inside a longer one of another family doesn't count.
- a window of ``WINDOW`` words around it that is classified as the mark's family, by one
  logistic regression per family against anything else, on hashed word n-grams (one to
  three words). Families don't compete: a window may be a notice of several.

The models are fitted on the driver from

- notices of each family: sentence frames around the family's names, its identifiers, its
  grants and headers, bare or amid words; and notices of two families in one window,
- notices of licences that don't exist, which belong to no family; n-grams that no family's
  notices have are left out,
- windows of at most ``SAMPLE_DOCS`` documents, those with the smallest hashed ids.

Every fifth of them is held out to calibrate: a temperature for the probabilities, and the
least probability at which a window may count for a family, so that at most
``FALSE_ALARMS`` of the held-out strangers do.

The fitted weights are sent to the tasks; their size is fixed. All words of all texts are
looked up among the marks' first words. A sum over n-grams of the most that any family can
gain bounds the outcome of each window around a mark; windows whose bound is too low can't
be notices, and the others are scored in full.

The grants of the two BSD families differ by a clause that one lacks, so the opening of a
grant goes by the clauses up to the next opening, over the whole text.

Defined cases: null and empty texts have no notice; a very long line is read whole;
``paragraph`` is the number of the line on which the mark begins, and each line gets one row
per family found, with its best window; rows that repeat a ``doc_id`` give their rows each.
Other columns never matter. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
WINDOW = 14
STRIDE = 3
SAMPLE_DOCS = 500
SAMPLE_CHARS = 4000  # of each sampled document, for fitting only
SAMPLE_WINDOWS = 6000
FALSE_ALARMS = 0.001
CONFIRMED = 0.8
SEED = 3
MIXED = 600  # fitted notices of two families in one window
REMEMBERED = 400_000

# The licence families, their identifier first, then what notices call them.
FAMILIES = {
    "MIT": ["the MIT License", "MIT license", "the MIT Licence (Expat)"],
    "Apache-2.0": ["the Apache License, Version 2.0", "Apache License 2.0", "the Apache 2.0 license"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3", "GPLv3 or later"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2", "GPLv2 or later"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "the GNU LGPL v3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU AGPL v3"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the New BSD License", "the modified BSD license"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the Simplified BSD License"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "MPL 2.0"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License, version 2.0"],
    "ISC": ["the ISC License", "the ISC licence"],
    "Unlicense": ["the Unlicense", "the Unlicense (public domain)"],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons Zero 1.0", "CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"],
}
FRAMES = (
    "Licensed under {}.", "Released under {}.", "This work is licensed under {}.",
    "Distributed under the terms of {}.", "This software is made available under {}.",
    "Published under {}, see the file LICENSE.", "SPDX-License-Identifier: {}",
)
# Headers and grants, the parts that tell a family.
GRANTS = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files"],
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not '
                   "use this file except in compliance with the License."],
    **{f"{short}-{n}.0": [
        f"under the terms of the {name} as published by the Free Software Foundation, either "
        f"version {n} of the License, or (at your option) any later version.",
        f"under the terms of the {name} version {n} as published by the Free Software Foundation",
        f"under the terms of version {n} of the {name}"]
       for short, name, n in [
           ("GPL", "GNU General Public License", 3), ("GPL", "GNU General Public License", 2),
           ("LGPL", "GNU Lesser General Public License", 3),
           ("AGPL", "GNU Affero General Public License", 3)]},
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission."],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."],
    "EPL-2.0": ["made available under the terms of the Eclipse Public License v2.0 which "
                "accompanies this distribution"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted, provided that the above copyright notice "
            "and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["The person who associated a work with this deed has dedicated the work to the "
                "public domain by waiving all of his or her rights"],
    **{f"CC-{kind}-4.0": [
        f"licensed under a Creative Commons {long} 4.0 International License.",
        f"https://creativecommons.org/licenses/{kind.lower()}/4.0/"]
       for kind, long in [
           ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
           ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives")]},
}
# Phrases of grants that count as marks, and the opening and closing clauses of
# grants of the BSD kind; others of that kind are no listed family.
PHRASES = {
    "MIT": ["permission is hereby granted free of charge to any person obtaining a copy of"],
    "ISC": ["with or without fee is hereby granted provided that the above copyright notice and"],
    "BSD-3-Clause": ["may be used to endorse or promote products derived from this software without"],
    "Unlicense": ["this is free and unencumbered software released into the public domain"],
    "CC0-1.0": ["associated a work with this deed has dedicated the work to the public domain"],
}
OPENING = "redistribution and use in source and binary forms with or without modification are permitted"
FOREIGN = ("all advertising materials mentioning features or use of this software must display",
           "the end-user documentation included with the redistribution")
SPDX = "spdx-license-identifier"
STRANGERS = (
    "the {} License", "the {} Public License, version 3", "{} BY 4.0", "the {} agreement",
    "{} License, Version 2.0", "the terms of {}", "the General {} License 2.0", "{} 1.0",
)

_TOKEN = re.compile(r"\w+(?:[-.+]\w+)*")
_A, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Hashes(dict):
    def __missing__(self, token: str) -> int:
        from xxhash import xxh3_64_intdigest

        found = xxh3_64_intdigest(token)
        if len(self) < REMEMBERED:
            self[token] = found
        return found


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def hashed_ngrams(words: np.ndarray, most: int = 3) -> list[np.ndarray]:
    """Hashes of the n-grams that begin at each word, for one, two, up to ``most`` words."""
    found, current = [], words
    for n in range(1, most + 1):
        mixed = current ^ current >> np.uint64(29)
        mixed = mixed * _C
        found.append(mixed ^ mixed >> np.uint64(32))
        if n < most:
            current = current[:-1] * _A + words[n:] if len(current) else current
    return found


def bucket(hashed: np.ndarray) -> np.ndarray:
    return (hashed % np.uint64(BUCKETS)).astype(np.int64)


def ngrams(words: np.ndarray, most: int = 3) -> list[np.ndarray]:
    """Buckets of the n-grams that begin at each word."""
    return list(map(bucket, hashed_ngrams(words, most)))


def features(words: np.ndarray) -> np.ndarray:
    return np.concatenate(ngrams(words))


def identifiers(family: str) -> list[str]:
    """The family's identifier, and its spellings in SPDX expressions."""
    forms = ("", "-only", "-or-later") if "GPL" in family else ("",)
    return [family + form for form in forms]


def notices(family: str) -> list[str]:
    frames = [f.format(n) for f, n in itertools.product(FRAMES[:-1], FAMILIES[family])]
    return [*frames, *map(FRAMES[-1].format, identifiers(family)), *GRANTS[family]]


def names(family: str) -> set[str]:
    """What only this family is called, in words, with the version where it has one."""
    found = {n.removeprefix("the ") for n in map(" ".join, map(tokens, FAMILIES[family]))}
    found |= {i.lower() for i in identifiers(family) if "-" in i}
    match family.split("-"):
        case ["MIT"]:
            found = {"mit license", "mit expat", "expat license", "mit licensed", "license mit",
                     "mit or apache", "mit and apache", "mit x11 license", "mit style license"}
        case ["ISC"]:
            found = {"isc license", "isc licensed", "license isc"}
        case ["Unlicense"]:
            found = {"unlicense"}
        case ["Apache", _]:
            found = {f"{a} {v}" for a in ("apache license", "apache software license", "asl")
                     for v in ("version 2.0", "version 2", "v2.0", "v2", "v 2.0", "2.0", "2")}
            found |= {f"apache {v} license" for v in ("2.0", "2", "v2", "v2.0", "version 2.0")}
            found |= {"apache-2.0", "apache2 license", "license apache 2.0", "or apache 2.0",
                      "and apache 2.0"}
        case [("GPL" | "LGPL" | "AGPL") as short, version]:
            n = version[0]
            kind = {"G": "", "L": "lesser ", "A": "affero "}[short[0]]
            full = f"{kind}general public license"
            called = [full, f"gnu {full}", short.lower(), f"gnu {short.lower()}", f"{kind}gpl",
                      f"gnu {kind}gpl", f"{full} {short.lower()}", f"gnu {full} {short.lower()}"]
            called += [f"{short.lower()} license"]
            versions = [f"{v}{n}{zero}" for v in ("version ", "v", "v ", "") for zero in ("", ".0")]
            by = "as published by the free software foundation"
            versions += [f"{by} either version {n}", f"{by} version {n}", f"either version {n}"]
            found |= {f"{c} {v}" for c in called for v in versions}
            found |= {f"version {n}{zero} of the {c}" for c in called for zero in ("", ".0")}
            found |= {short.lower() + v for v in (f"v{n}", f"{n}", f"v{n}.0", f"-{n}", f"-v{n}")}
        case ["BSD", n, _]:
            other = {"3": ("new", "modified", "revised"), "2": ("simplified", "freebsd")}[n]
            count = {"3": "three", "2": "two"}[n]
            clause = [f"{n}-clause", f"{n} clause", f"{count}-clause", f"{count} clause"]
            found |= {f"bsd {c}" for c in clause} | {f"{c} bsd" for c in clause}
            found |= {f"{o} bsd license" for o in other} | {f"{o} bsd" for o in other}
            found |= {"freebsd license"} if n == "2" else set()
        case [("MPL" | "EPL") as short, _]:
            full = {"M": "mozilla public license", "E": "eclipse public license"}[short[0]]
            found |= {f"{c} {v}" for c in (full, short.lower(), f"{full} {short.lower()}")
                      for v in ("version 2.0", "version 2", "v2.0", "v2", "v 2.0", "2.0", "2")}
            found |= {f"{short.lower()}{v}" for v in ("2", "v2", "2.0")}
        case ["CC0", _]:
            found |= {"cc0", "creative commons zero", "creativecommons.org publicdomain zero 1.0"}
        case ["CC", *kind, _]:
            kind = "-".join(kind).lower()
            long = {"by": ["attribution"], "by-sa": ["attribution-sharealike"],
                    "by-nc": ["attribution-noncommercial", "attribution-non-commercial"],
                    "by-nd": ["attribution-noderivatives", "attribution-noderivs",
                              "attribution-no derivatives"]}[kind]
            parts = [x for k in long for x in (k, k.replace("-", " "))]
            found |= {f"{c} {v}" for v in ("4.0", "v4.0", "version 4.0")
                      for c in (f"cc {kind}", f"cc-{kind}", *(f"creative commons {k}" for k in parts))}
            found |= {f"creativecommons.org licenses {kind} 4.0", f"cc {kind}-4.0"}
            found |= {f"creative commons {k} international 4.0" for k in parts}
    found |= {n.replace("license", word) for n in found for word in ("licence", "licenses")}
    return {n for n in found if n}


def marks() -> list[tuple[str, list[str], bool]]:
    """``(family, words, whole)``; of those that needn't be whole a share is enough."""
    found = [(f, n.split(), True) for f in FAMILIES for n in sorted(names(f))]
    found += [(f, p.split(), False) for f, phrases in PHRASES.items() for p in phrases]
    found += [("opening", OPENING.split(), False), (SPDX, [SPDX], True)]
    return found + [("foreign", p.split(), False) for p in FOREIGN]


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


class Marks:
    """Finds marks; an entry stands under words that begin it, or under any of a phrase."""

    def __init__(self):
        self.entries: dict[tuple, list[tuple[str, list[str], bool, int]]] = {}
        for name, words, whole in marks():
            places = [0] if whole else [i for i in range(len(words) - 1)
                                        if len(words[i]) + len(words[i + 1]) >= 9]
            for i in places:
                key = tuple(words[i:i + 2])
                self.entries.setdefault(key, []).append((name, words, whole, i))
        self.identifiers = {i.lower(): f for f in FAMILIES for i in identifiers(f)}
        hashes = Hashes()
        self.begins = [np.zeros(BUCKETS, bool) for _ in range(2)]
        for key in self.entries:
            words = np.fromiter(map(hashes.__getitem__, key), np.uint64, len(key))
            self.begins[len(key) - 1][ngrams(words, len(key))[-1]] = True

    def found(self, words: list[str], grams: list[np.ndarray], ends) -> list[tuple]:
        """``(begin, end, family, similarity)``; ``ends(i)`` has the bounds of word ``i``'s
        paragraph."""
        raw: dict[tuple, float] = {}
        for n, begins in enumerate(self.begins):
            for i in np.flatnonzero(begins[grams[n]]).tolist():
                for name, mark, whole, offset in self.entries.get(tuple(words[i:i + n + 1]), ()):
                    low, high = ends(i)
                    start, stop = i - offset, i - offset + len(mark)
                    if name == SPDX:
                        for j in range(i + 1, high, 2):
                            if words[j] in self.identifiers:
                                raw[j, j + 1, self.identifiers[words[j]]] = 1.0
                            if j + 1 >= high or words[j + 1] not in ("or", "and", "with"):
                                break
                    elif start < low or stop > high:
                        continue
                    elif whole:
                        if words[start:stop] == mark:
                            raw[start, stop, name] = 1.0
                    else:
                        same = sum(words[start + k:start + k + 2] == mark[k:k + 2]
                                   for k in range(len(mark) - 1)) / (len(mark) - 1)
                        if same >= CONFIRMED:
                            raw[start, stop, name] = same
        if not raw:
            return []
        # The clauses up to the next opening tell the family of a grant of the BSD kind.
        order, kept = sorted(raw), []
        for k, (begin, end, name) in enumerate(order):
            if name == "opening":
                rest = [m[2] for m in itertools.takewhile(
                    lambda m: m[2] != "opening", order[k + 1:])]
                name = ("foreign" if "foreign" in rest else
                        "BSD-3-Clause" if "BSD-3-Clause" in rest else "BSD-2-Clause")
            elif name == "BSD-3-Clause" and end - begin > 10:
                near = [m[2] for m in order[:k] if m[2] in ("opening", "foreign")]
                name = "foreign" if near and near[-1] == "foreign" else name
            if name != "foreign":
                kept.append((begin, end, name, raw[order[k]]))
        # A longer mark around a shorter one begins no later: look back while one may reach.
        clear, longest = [], max(m[1] - m[0] for m in kept) if kept else 0
        begins = [m[0] for m in kept]
        for begin, end, name, same in kept:
            around = kept[bisect_right(begins, begin - longest):bisect_right(begins, begin)]
            if not any(b <= begin and end <= e and e - b > end - begin and f != name
                       for b, e, f, _ in around):
                clear.append((begin, end, name, same))
        return clear


class Model:
    """Weights, temperature and threshold; classes are the families, then anything else,
    whose weights are 0: a family's logit is for it against anything else."""

    def __init__(self, strange: list[str]):
        self.names = list(FAMILIES)
        self.label = {name: i for i, name in enumerate(self.names)}
        self.marks = Marks()
        hashes, rng = Hashes(), np.random.default_rng(SEED)
        texts = [tokens(t) for t in strange] or [["text"]]
        plain = np.array([w for t in texts for w in t])
        rows, labels = [], []

        def hashed(words: list[str]) -> np.ndarray:
            return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))

        # What is fitted: notices, and the marks, in windows that hold their beginning or end.
        given = {name: [tokens(t) for t in notices(name)] for name in self.names}
        for name, words, _ in marks():
            for family in ("BSD-3-Clause", "BSD-2-Clause") if name == "opening" else (name,):
                if family in given:
                    given[family].append(words)
        # Only n-grams of notices have weights; the words around them say nothing.
        self.known = np.unique(np.concatenate([
            h for words in itertools.chain.from_iterable(given.values())
            for h in hashed_ngrams(hashed(words))]))
        # A bucket without weights stands for the others, also where their own is shared.
        self.blank = int(np.setdiff1d(np.arange(BUCKETS), bucket(self.known))[0])

        def add(words: list[str], *truth: int) -> None:
            found = np.concatenate(self.grams(hashed(words)))
            rows.append(found[found != self.blank])
            labels.append(np.isin(np.arange(len(self.names)), truth))

        def amid(words: list[str], *truth: int, times: int = 8) -> None:
            """Bare, and within a window of other words."""
            add(words, *truth)
            for _ in range(times):
                before, after = (texts[i] for i in rng.integers(0, len(texts), 2))
                room = rng.integers(0, max(0, WINDOW - len(words)) + 1)
                at = rng.integers(0, room + 1)
                add([*before[len(before) - at:], *words[:WINDOW], *after[:room - at]], *truth)

        opening = OPENING.split()[:5]
        for label, name in enumerate(self.names):
            for words in given[name]:
                both = words[:5] == opening
                truth = [self.label[f] for f in ("BSD-3-Clause", "BSD-2-Clause")] if both else [label]
                amid(words, *truth, times=24 if len(words) == 1 else 3 if len(words) < 6 else 8)
        for _ in range(MIXED):  # two families in one window
            one, two = rng.choice(len(self.names), 2, replace=False)
            parts = [given[self.names[i]] for i in (one, two)]
            first, second = ([p for p in part if len(p) <= WINDOW // 2] for part in parts)
            words = [*first[rng.integers(len(first))], str(rng.choice(["or", "and", "the"])),
                     *second[rng.integers(len(second))]]
            amid(words, one, two, times=1)
            several = rng.choice(len(self.names), rng.integers(2, 5), replace=False)
            words = [SPDX]
            for i in several:
                words += [str(rng.choice(identifiers(self.names[i]))).lower(),
                          str(rng.choice(["or", "and"]))]
            amid(words[:-1], *several, times=1)
        for frame, stranger in itertools.product(FRAMES, STRANGERS):
            for name in rng.choice(plain, 6):
                amid(tokens(frame.format(stranger.format(name))))
        for text in strange:
            add(tokens(text))
        self._fit(rows, np.array(labels), rng)

    def grams(self, words: np.ndarray) -> list[np.ndarray]:
        """Buckets of known n-grams; the others stand in the blank one."""
        found = []
        for h in hashed_ngrams(words):
            place = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            found.append(np.where(self.known[place] == h, bucket(h), self.blank))
        return found

    def _fit(self, rows: list[np.ndarray], labels: np.ndarray, rng) -> None:
        """Gradient descent with per-weight step sizes, in small batches."""
        order = rng.permutation(len(rows))
        held, train = order[::5], np.delete(order, np.s_[::5])
        classes = len(self.names) + 1
        self.weights = np.zeros((BUCKETS, classes), np.float32)
        self.bias = np.zeros(classes, np.float32)
        self.temperature = 1.0
        squares = np.full_like(self.weights, 1e-6)
        for _ in range(6):
            for batch in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
                flat = np.concatenate([rows[i] for i in batch])
                owner = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
                logits = self._logits([rows[i] for i in batch])
                error = np.zeros_like(logits)
                error[:, :-1] = self._probabilities(logits) - labels[batch]
                used, place = np.unique(flat, return_inverse=True)
                slope = np.zeros((len(used), classes), np.float32)
                np.add.at(slope, place, error[owner])
                slope = slope / len(batch) + 1e-5 * self.weights[used]
                squares[used] += slope ** 2
                self.weights[used] -= 0.3 * slope / np.sqrt(squares[used])
                self.bias -= 0.1 * error.mean(axis=0)
        logits = self._logits([rows[i] for i in held])
        truth = labels[held]

        def loss(temperature: float) -> float:
            found = self._probabilities(logits / temperature)
            return -np.log(np.where(truth, found, 1 - found) + 1e-9).mean()

        self.temperature = min(np.geomspace(0.25, 8, 25), key=loss)
        found = self._probabilities(logits / self.temperature)
        best = np.sort(found[~truth.any(axis=1)].max(axis=1))
        self.threshold = max(0.5, float(best[int((1 - FALSE_ALARMS) * (len(best) - 1))]))
        self.accuracy = float(((found > 0.5) == truth).all(axis=1).mean())
        # A family can't reach the threshold unless its logit passes that of anything else.
        self.gain = (self.weights[:, :-1] - self.weights[:, -1:]).max(axis=1)
        self.gain_bias = float((self.bias[:-1] - self.bias[-1]).max())

    def _logits(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.stack([self.weights[r].sum(axis=0) for r in rows]) + self.bias

    @staticmethod
    def _probabilities(logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(logits[:, -1:] - logits[:, :-1], -60, 60)))

    def possible(self, begin: np.ndarray, end: np.ndarray, grams: list[np.ndarray]) -> np.ndarray:
        """Windows whose bound lets some family win; ``end`` may be past the n-grams' ends."""
        total = np.full(len(begin), self.gain_bias)
        for n, buckets in enumerate(grams):
            sums = np.concatenate([[0.0], np.cumsum(self.gain[buckets], dtype=np.float64)])
            last = len(buckets)
            total += sums[np.minimum(np.maximum(end - n, begin), last)] - sums[np.minimum(begin, last)]
        return np.flatnonzero(total > -1e-3)

    def scan(self, text: str | None, hashes: Hashes) -> list[tuple[int, str, float, float]]:
        """``(paragraph, family, probability, similarity)``."""
        words, first, block = [], [], [0]  # first words of lines and of paragraphs
        for line in (text or "").split("\n"):
            first.append(len(words))
            found = tokens(line)
            if not found and block[-1] != len(words):
                block.append(len(words))
            words += found
        if not words:
            return []

        def ends(i: int) -> tuple[int, int]:
            k = bisect_right(block, i)
            return block[k - 1], block[k] if k < len(block) else len(words)

        hashed = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        marked = self.marks.found(words, ngrams(hashed, 2), ends)
        if not marked:
            return []
        # Every window that holds a whole mark, or begins with a longer one.
        begin, end, owner = [], [], []
        for k, (start, stop, _, _) in enumerate(marked):
            low, high = ends(start)
            for at in range(max(low, min(stop - WINDOW, start)), start + 1):
                begin.append(at)
                end.append(min(at + WINDOW, high))
                owner.append(k)
        found, grams = {}, self.grams(hashed)
        for i in self.possible(np.array(begin), np.array(end), grams):
            start, _, family, similarity = marked[owner[i]]
            row = np.concatenate([g[begin[i]:max(begin[i], end[i] - n)] for n, g in enumerate(grams)])
            logits = self._logits([row])
            chance = float(self._probabilities(logits / self.temperature)[0][self.label[family]])
            key = bisect_right(first, start) - 1, family
            if chance >= self.threshold and (similarity, chance) > found.get(key, (0, 0)):
                found[key] = similarity, chance
        return [(*key, chance, similarity) for key, (similarity, chance) in found.items()]


def strangers(docs: DataFrame) -> list[str]:
    """Windows of a bounded sample of documents, without anything like a notice."""
    place = F.xxhash64("doc_id", "text")
    rows = docs.where(F.col("text").isNotNull())
    # Hashes first: the top of each task must not carry its texts to the driver.
    first = rows.select(place.alias("place")).orderBy("place").limit(SAMPLE_DOCS)
    last = first.agg(F.max("place")).first()[0]
    sample = rows.where(place <= last) if last is not None else rows
    rows = sample.select(place.alias("place"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    rows = sorted(rows.limit(SAMPLE_DOCS).collect())
    templates = [pairs(tokens(t)) for name in FAMILIES for t in notices(name)]
    templates += [pairs(words) for _, words, _ in marks() if len(words) > 1]
    some = set().union(*templates)
    found = []
    for row in rows:
        for line in row["text"].split("\n"):
            words = tokens(line)
            for i in range(0, len(words), WINDOW):
                held = pairs(words[i:i + WINDOW]) & some
                if not held or all(len(t & held) < len(t) / 2 for t in templates):
                    found.append(" ".join(words[i:i + WINDOW]))
    return found[:SAMPLE_WINDOWS]


def scanned(docs: DataFrame) -> DataFrame:
    """``(doc_id, paragraph, family, probability, similarity)`` of each notice found."""
    model = docs.sparkSession.sparkContext.broadcast(Model(strangers(docs)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            rows = [(doc_id, *hit) for doc_id, text in zip(*(c.to_pylist() for c in batch.columns))
                    for hit in model.value.scan(text, hashes)]
            values = list(zip(*rows)) if rows else [()] * 5
            kinds = (batch.schema.field(0).type, pa.int32(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)],
                ["doc_id", "paragraph", "family", "probability", "similarity"])

    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, paragraph int, family string, probability double, similarity double")
