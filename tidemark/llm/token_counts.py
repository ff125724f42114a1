"""Exact token counts of every prefix, by prefix dynamic programming.

A sequence of tokens is what byte-pair merging yields exactly if each neighbouring pair is:
merging the pair's own bytes gives the two tokens back. So the last token of a prefix is the
one vocabulary entry that ends it and fits the last token of the prefix before it, and the
count of the prefix is one more than that prefix's count. One left-to-right pass over a
piece yields the counts of all its prefixes.

Texts fall into units (see ``tokens``) that don't influence each other. Each distinct unit's
table is computed once per task; a text's table is the running sum of its units' tables.
The pieces that a run of texts brings are counted in the order of their bytes: neighbours
begin alike, and what two pieces share is counted once.
Counts, truncation points and budget checks all read these tables; nothing is encoded again.

Defined cases: a null text is empty and has 0 tokens; the tokenizer's special string counts
as one token, as the library's default has it; no tokens are added at either end. Rows that
repeat a ``doc_id`` are counted each. Other columns never matter. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress, repeat
from operator import is_, ne

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.tokens import (
    REMEMBERED,
    UNIT,
    WHITE,
    Irregular,
    Values,
    tokenizer,
    vocabulary,
)

LIMIT = 512
# Letters, then marks that no contraction begins with: two pre-tokens at most.
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@]*)")
# Per byte, 1 if a character begins with it.
BEGINS = bytes(not 0x80 <= b < 0xC0 for b in range(256))
RUN_CHARS = 8_000_000  # characters of the texts whose new pieces are counted in one go
UNKNOWN = b"\0"  # stands for the table of a word not met before


class Merges:
    """Byte-pair merging of one piece, and the counts of all its prefixes."""

    def __init__(self, path: str):
        self.ids, self.ranks, _ = vocabulary(path)
        self.raw = {number: token for token, number in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.fits: dict[int, bool] = {}
        self.joins: dict[int, int] = {}
        self.halves = self.split_ids()
        # Of the piece counted last: per prefix, its tokens, its last token and where that begins.
        self.piece, self.counts, self.last, self.starts = b"", [0], [0], [0]

    def split_ids(self) -> dict[int, tuple[int, int]] | None:
        """The two ids that each id is merged from. None where ids don't follow the order of
        the merges, or some token's bytes merge to something else: pairs are then merged."""
        ids, found = self.ids, {}
        for a, b in sorted(self.ranks, key=self.ranks.get):
            token = ids.get(a + b, -1)
            if token <= next(reversed(found), max(self.single)):
                return None
            found[token] = ids[a], ids[b]
            self.joins[ids[a] << 20 | ids[b]] = token
        if len(found) + len(set(self.single)) != len(ids):
            return None
        self.halves = found
        return found if all(self.apart(a, b, token) for token, (a, b) in found.items()) else None

    def apart(self, a: int, b: int, limit: int = 1 << 40) -> bool:
        """Whether no merge before ``limit`` spans the border of two tokens that stand side by
        side: taken apart again, the younger one first, none of the pairs there is merged before
        the token that one of them became part of."""
        joins, halves = self.joins.get, self.halves.get
        while True:
            if joins(a << 20 | b, limit) < limit:
                return False
            left, right = halves(a), halves(b)
            if left and (not right or a > b):
                limit, a = a, left[1]
            elif right:
                limit, b = b + 1, right[0]
            else:
                return True

    def merged(self, piece: bytes) -> list[bytes]:
        """Tokens of a short piece, by merging."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            known = [(self.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:]))
                     if p in self.ranks]
            if not known:
                break
            _, i = min(known)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fit(self, key: int) -> bool:
        """Whether token ``key >> 20`` may stand before token ``key & 0xfffff``."""
        if len(self.fits) >= REMEMBERED:
            self.fits.clear()
        if self.halves is None:
            pair = [self.raw[key >> 20], self.raw[key & 0xFFFFF]]
            found = self.merged(b"".join(pair)) == pair
        else:
            found = self.apart(key >> 20, key & 0xFFFFF)
        self.fits[key] = found
        return found

    def prefixes(self, piece: bytes) -> list[int]:
        """Token counts of ``piece[:1]``, ``piece[:2]``, ... ``piece``.

        Prefixes that the piece counted before has, too, are not counted again. Only one last
        token fits, so the order of trials is free: first the last token made longer by a byte,
        then that byte alone, then the rest from the longest on.
        """
        known, fits, single = self.ids.get, self.fits.get, self.single
        counts, last, starts = self.counts, self.last, self.starts
        shorter = min(len(self.piece), len(piece))
        same = next(compress(range(shorter), map(ne, self.piece, piece)), shorter)
        del counts[same + 1:], last[same + 1:], starts[same + 1:]
        self.piece, begin = piece, starts[same]
        for end in range(same + 1, len(piece) + 1):
            token = known(piece[begin:end])
            if token is not None:
                fit = True
                if begin:
                    key = last[begin] << 20 | token
                    fit = fits(key)
                    if fit is None:
                        fit = self.fit(key)
                if fit:
                    counts.append(counts[begin] + 1)
                    last.append(token)
                    starts.append(begin)
                    continue
            token, start = single[piece[end - 1]], end - 1
            key = last[start] << 20 | token
            fit = fits(key)
            if not (self.fit(key) if fit is None else fit):
                start, token = self.fitting(piece, end, last)
            counts.append(counts[start] + 1)
            last.append(token)
            starts.append(start)
            begin = start
        return counts[1:]

    def fitting(self, piece: bytes, end: int, last: list[int]) -> tuple[int, int]:
        """Start and id of the last token of ``piece[:end]``."""
        for start in range(max(0, end - self.longest), end):
            token = self.ids.get(piece[start:end])
            if token is not None:
                key = last[start] << 20 | token
                fit = not start or self.fits.get(key)
                if self.fit(key) if fit is None else fit:
                    return start, token
        raise ValueError("a byte has no token")


def compact(counts: list[int]) -> bytes | array:
    try:
        return bytes(counts)
    except ValueError:
        return array("I", counts)


def appended(tables: Iterable[bytes | array]) -> bytes | array:
    """One table of units that follow each other."""
    base, found = 0, []
    for table in tables:
        found += [base + n for n in table] if base else table
        base = found[-1]
    return compact(found)


class PrefixCounter:
    """Tables of prefix counts, by character."""

    def __init__(self, path: str):
        library = tokenizer(path)
        self.merges = Merges(path)
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.pieces: dict[str, bytes | array] = {}
        self.specials = sorted(vocabulary(path)[2])
        self.cut = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.tables = Values(self.unit, appended)

    def piece(self, text: str) -> bytes | array:
        """Counts at each character of one pre-token."""
        known = self.pieces.get(text)
        if known is not None:
            return known
        counts = self.counted(text)
        if len(self.pieces) < REMEMBERED // 4:
            self.pieces[text] = counts
        return counts

    def counted(self, text: str) -> bytes | array:
        raw = text.encode()
        counts = self.merges.prefixes(raw)
        if len(raw) != len(text):
            counts = list(compress(counts, (raw[1:] + b" ").translate(BEGINS)))
        return compact(counts)

    def learn(self, words: set[str]) -> None:
        """Tables of words that follow a blank, by way of their pieces in order."""
        plain, pieces = [], set()
        for word in words:
            match = PLAIN.fullmatch(f" {word}")
            if match:
                plain.append((word, *match.groups()))
                pieces.update(match.groups())
            else:
                for unit in UNIT.findall(f" {word}"):
                    body = unit.lstrip(WHITE)
                    pieces.update(self.pieces_of(f" {body}" if unit[0] == " " else body))
        pieces.difference_update(self.pieces, ("",))
        for piece in sorted(pieces):
            self.pieces[piece] = self.counted(piece)
        known = self.pieces
        self.tables.words.update({
            word: appended((known[body], known[marks])) if marks else known[body]
            for word, body, marks in plain})

    def forget(self) -> None:
        """Drop what was learnt last, beyond what is kept."""
        for known, kept in ((self.tables.words, REMEMBERED), (self.pieces, REMEMBERED // 4)):
            while len(known) > kept:
                known.popitem()

    def pieces_of(self, text: str) -> list[str]:
        """Pre-tokens of text without white space but for a leading blank."""
        plain = PLAIN.fullmatch(text)
        if plain:
            return [p for p in plain.groups() if p]
        return [text[begin:end] for _, (begin, end) in self.split(text)]

    def unit(self, unit: str) -> bytes | array:
        """Counts at each character of a run of white space and the run of others behind it."""
        plain = PLAIN.fullmatch(unit)
        if plain:
            word, marks = plain.groups()
            return appended((self.piece(word), self.piece(marks))) if marks else self.piece(word)
        body = unit.lstrip(WHITE)
        white = unit[:len(unit) - len(body)]
        found = list(self.piece(white)) if white else []
        base = 0
        if body and white:
            # White space before others is split before its last character; a blank there
            # opens the next piece, anything else is a piece of its own.
            base = found[-2] if len(white) > 1 else 0
            if white[-1] != " ":
                base += self.piece(white[-1])[-1]
        text = " " + body if white[-1:] == " " else body
        skip = len(text) - len(body)
        for part in self.pieces_of(text) if body else ():
            counts = self.piece(part)
            if part in ("'re", "'ve", "'ll"):  # cut short, it is an apostrophe and a letter
                counts = [1, 2, counts[2]]
            found += [base + n for n in counts[skip:]] if base or skip else counts
            base += counts[-1]
            skip = 0
        return compact(found)

    @staticmethod
    def joined(tables: Iterable[bytes | array]) -> np.ndarray:
        base, found = 0, [np.zeros(0, np.int64)]
        for table in tables:
            found.append(np.array(table if isinstance(table, array) else list(table)) + base)
            base += table[-1]
        return np.concatenate(found)

    def plain(self, text: str) -> list:
        """Tables of the units of a text without special strings."""
        return self.tables.per_text(text)

    def totals(self, texts: list[str]) -> list[int]:
        """Token counts of whole texts, a run of texts at a time."""
        found, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < RUN_CHARS:
                size += len(texts[end])
                end += 1
            found += self.run(texts[at:end])
            at = end
        return found

    def run(self, texts: list[str]) -> list[int]:
        """Token counts of texts: known words are looked up, then all new ones are learnt."""
        known, rest, fresh = self.tables.words, [], set()
        for text in texts:
            first, *words = text.split(" ")
            tables = list(map(known.get, words, repeat(UNKNOWN)))
            new = list(compress(words, map(is_, tables, repeat(UNKNOWN))))
            fresh.update(new)
            rest.append((first, sum([t[-1] for t in tables]), new))
        self.learn(fresh)
        found = []
        for text, (first, total, new) in zip(texts, rest):
            try:
                if self.cut and self.cut.search(text):
                    raise Irregular
                total += sum([t[-1] for t in self.plain(first)])
                found.append(total + sum([known[word][-1] for word in new]))
            except Irregular:
                found.append(self.total(text))
        self.forget()
        return found

    def table(self, text: str) -> np.ndarray:
        """Token count of every prefix of ``text``, by characters.

        A prefix that ends inside a special string is ordinary text.
        """
        base, begin, found = 0, 0, []
        for match in self.cut.finditer(text) if self.cut else ():
            counts = self.joined(self.plain(text[begin:match.end() - 1])) + base
            if match.start() > begin:
                base = int(counts[match.start() - begin - 1])
            base, begin = base + 1, match.end()
            found += [counts, [base]]
        found.append(self.joined(self.plain(text[begin:])) + base)
        return np.concatenate(found).astype(np.int64)

    def total(self, text: str) -> int:
        """Token count of the whole text."""
        specials = self.cut.findall(text) if self.cut else []
        parts = self.cut.split(text) if specials else [text]
        return len(specials) + sum([t[-1] for part in parts for t in self.plain(part)])

    def longest(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if self.cut and self.cut.search(text):
            fits = np.flatnonzero(self.table(text) <= budget)
            return int(fits[-1]) + 1 if len(fits) else 0
        base = chars = 0
        for table in self.plain(text):
            if base + table[-1] > budget:
                return chars + max((i + 1 for i, n in enumerate(table) if base + n <= budget),
                                   default=0)
            base += table[-1]
            chars += len(table)
        return chars


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT,
                 tables: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit, fitting_chars)``, one row per document.

    ``fitting_chars`` is the length of the longest prefix of at most ``limit`` tokens. With
    ``tables`` a column ``prefix_tokens`` holds the count of every prefix, one per character.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            totals = counts.totals(texts)
            columns = {
                "doc_id": batch.column(0),
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array(totals, pa.int64()),
                "over_limit": pa.array([n > limit for n in totals], pa.bool_()),
                "fitting_chars": pa.array(
                    [len(t) if n <= limit else counts.longest(t, limit)
                     for t, n in zip(texts, totals)], pa.int64()),
            }
            if tables:
                columns["prefix_tokens"] = pa.array(
                    [counts.table(t).tolist() for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, "
              "fitting_chars bigint" + ", prefix_tokens array<bigint>" * tables)
    return docs.select("doc_id", "text").mapInArrow(count, schema)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)
