"""Hashes of the words of many texts at once: white space splits them, prefix sums hash them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from tidebook.llm.cuckoo import mixed

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 21
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
GAP = re.compile(rb"[\t-\r ]")


class Powers:
    """Powers of the hash base and of its inverse, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def of(base_value: int, size: int) -> np.ndarray:
        factors = np.full(size, base_value, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            self.up, self.down = self.of(BASE, 2 * size), self.of(INVERSE, 2 * size)
        return self.up[:size], self.down[:size]


class Hashes:
    """Hashes of any stretch of a sequence of symbols, by prefix sums."""

    def __init__(self, symbols: np.ndarray, powers: Powers) -> None:
        up, self.down = powers.upto(len(symbols) + 1)
        self.prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.prefix[1:], dtype=np.uint64)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[begin]) * self.down[begin] + (end - begin).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        return mixed((self.prefix[size:] - self.prefix[:-size]) * self.down[: len(self.prefix) - size])


def hashes_in(raw: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of a stretch of text that ends in white space."""
    symbols = np.frombuffer(raw, np.uint8)
    space = SPACE[symbols]
    turns = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        turns = np.concatenate([[0], turns])
    starts, ends = turns[::2], turns[1::2]
    return Hashes(symbols, powers).of(starts, ends), starts


def cut_long(raw: bytes) -> Iterator[bytes]:
    """A long text in pieces of bounded size that end between words, where it has any gaps."""
    begin = 0
    while len(raw) - begin > PIECE:
        gap = GAP.search(raw, begin + PIECE)
        if gap is None:
            break
        yield raw[begin : gap.start()]
        begin = gap.start()
    yield raw[begin:]


def word_hashes(raws: list[bytes], powers: Powers, lower: bool = False) -> list[np.ndarray]:
    """The hashes of the words of each text, with A-Z in lower case if wanted."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0
    for raw in raws:
        if len(raw) > PIECE:
            out += batch_hashes(held, powers, lower)
            held, size = [], 0
            out.append(np.concatenate([batch_hashes([part], powers, lower)[0] for part in cut_long(raw)]))
            continue
        held.append(raw)
        size += len(raw) + 1
        if size > PIECE:
            out += batch_hashes(held, powers, lower)
            held, size = [], 0
    return out + batch_hashes(held, powers, lower)


def batch_hashes(raws: list[bytes], powers: Powers, lower: bool) -> list[np.ndarray]:
    if not raws:
        return []
    joined = b"\n".join([*raws, b""])
    hashes, starts = hashes_in(joined.lower() if lower else joined, powers)
    ends = np.cumsum([len(r) + 1 for r in raws])
    return np.split(hashes, np.searchsorted(starts, ends)[:-1])
