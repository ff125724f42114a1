"""Token ids of whole texts, and the units a text falls into.

The byte-level pre-tokenizer never joins characters across a change from other characters to
white space, so a text falls into units (a run of white space, then a run of other
characters) whose tokens don't depend on what stands around them. What is known of a unit is
remembered within a task. Where single blanks separate the words, ``str.split`` finds the
units. Where blanks meet other white space, a pattern does.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# The white space of the tokenizer's pattern (Unicode White_Space).
WHITE = "".join(map(chr, (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239,
                          8287, 12288)))
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
INNER = re.compile(f"[{WHITE}]")
RUN = re.compile(f"[{WHITE}]+")
# Fixed value: how the byte-level pre-tokenizer splits text.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LONG_RUN = 500_000  # white space in a row; the faster library fails from 1,000,000 on
REMEMBERED = 1_200_000  # units a worker keeps, about 200 bytes each; others are computed anew


class Irregular(Exception):
    """Blanks next to other white space: units must be found by the pattern."""


class Units(dict):
    """Value of each unit, computed when first met."""

    def __init__(self, value):
        self.value = value

    def __missing__(self, unit: str):
        found = self.value(unit)
        if len(self) < REMEMBERED:
            self[unit] = found
        return found


class Words(Units):
    """Values of words that follow a single blank; ``units`` has those of other units."""

    def __init__(self, units: Units, join):
        self.units, self.join = units, join

    def __missing__(self, word: str):
        if not word or word[0].isspace():
            raise Irregular
        unit = f" {word}"
        if INNER.search(word):  # words around a line break rarely come again
            return self.join(map(self.units.__getitem__, UNIT.findall(unit)))
        found = self.units.value(unit)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


class Values:
    """``per_text(text)`` gives the values of a text's units, in order."""

    def __init__(self, value, join):
        self.units = Units(value)
        self.words = Words(self.units, join)

    def per_text(self, text: str) -> list:
        first, *rest = text.split(" ")
        try:
            head = list(map(self.units.__getitem__, UNIT.findall(first)))
            return head + list(map(self.words.__getitem__, rest))
        except Irregular:
            return list(map(self.units.__getitem__, UNIT.findall(text)))


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[str, int]:
    """Byte of each letter in the vocabulary file: visible Latin-1 stands for itself, the
    other bytes in order for the letters from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def vocabulary(path: str) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int], dict[str, int]]:
    """Ids of the ordinary tokens, ranks of the merges, and ids of the special tokens."""
    letters = byte_letters()
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    model = content["model"]

    def raw(token: str) -> bytes:
        return bytes(map(letters.__getitem__, token))

    ids = {raw(token): number for token, number in model["vocab"].items() if token not in special}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return ids, {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}, special


@lru_cache(maxsize=2)
def largest_id(path: str) -> int:
    return max(tokenizer(path).get_vocab().values())


class Encoder:
    """Ids of whole texts as little-endian integers of ``dtype``.

    Where a vocabulary's ids follow the order of its merges, a second library can merge by
    id; it gives the same ids several times faster. Any other vocabulary is left to its own,
    and so is a text with a run of white space too long for the second library's pattern.
    """

    def __init__(self, path: str, dtype: str = "<u4"):
        self.dtype, self.library, self.fast = np.dtype(dtype), tokenizer(path), None
        if largest_id(path) > np.iinfo(self.dtype).max:
            raise ValueError(f"ids up to {largest_id(path)} don't fit into {self.dtype}")
        ids, merges, special = vocabulary(path)
        order = [ids.get(a + b, -1) for a, b in merges]
        if order == sorted(order) and len(set(order)) == len(order) and min(order) >= 256:
            from tiktoken import Encoding

            self.fast = Encoding("own", pat_str=PATTERN, mergeable_ranks=ids,
                                 special_tokens=special)

    @staticmethod
    def long_run(text: str) -> bool:
        return len(text) >= LONG_RUN and any(
            m.end() - m.start() >= LONG_RUN for m in RUN.finditer(text))

    def count(self, text: str | None) -> int:
        if self.fast is None or self.long_run(text or ""):
            return len(self.array(text))
        return len(self.fast.encode_to_numpy(text or "", allowed_special="all"))

    def array(self, text: str | None) -> np.ndarray:
        if self.fast is None or self.long_run(text or ""):
            found = self.library.encode(text or "", add_special_tokens=False).ids
            return np.array(found, self.dtype)
        return self.fast.encode_to_numpy(text or "", allowed_special="all").astype(self.dtype)

    def __call__(self, text: str | None) -> bytes:
        return self.array(text).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str, dtype: str = "<u4") -> Encoder:
    """An encoder that the tasks of a worker process share."""
    return Encoder(path, dtype)
