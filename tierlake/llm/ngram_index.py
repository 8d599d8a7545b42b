"""Word n-grams of a bounded set of passages, looked up in texts of any length."""

import re

import numpy as np

WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    """Lower-cased runs of word characters; null has none."""
    return WORD.findall(text.lower()) if text else []


class Codes:
    """Numbers for the words of the passages; any other word is -1."""

    def __init__(self, passages: list[list[str]]):
        self.of = {}
        for p in passages:
            for w in p:
                self.of.setdefault(w, len(self.of))
        if len(self.of) > 2_000_000:
            raise ValueError("too many different words for one block of passages")

    def encode(self, ws: list[str]) -> np.ndarray:
        get = self.of.get
        return np.array([get(w, -1) for w in ws], np.int64)

    def grams(self, codes: np.ndarray, n: int = 3) -> np.ndarray:
        """Key of the n-gram at each position; -1 where a word is unknown."""
        if len(codes) < n:
            return np.empty(0, np.int64)
        size = len(codes) - n + 1
        key, known = np.zeros(size, np.int64), np.ones(size, bool)
        for i in range(n):
            part = codes[i:i + size]
            key = key * len(self.of) + part
            known &= part >= 0
        return np.where(known, key, -1)


class Places:
    """Sorted n-gram keys with the (passage, position) pairs that hold them."""

    def __init__(self, keys: np.ndarray, passage: np.ndarray, position: np.ndarray):
        order = np.lexsort((position, passage, keys))
        self.keys, self.passage, self.position = keys[order], passage[order], position[order]

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text position, passage, passage position) of every shared n-gram."""
        at = np.flatnonzero(grams >= 0)
        if not len(at) or not len(self.keys):
            return at[:0], at[:0], at[:0]
        lo = np.searchsorted(self.keys, grams[at], "left")
        many = np.searchsorted(self.keys, grams[at], "right") - lo
        at, lo, many = at[many > 0], lo[many > 0], many[many > 0]
        rep = np.repeat(np.arange(len(at)), many)
        entry = lo[rep] + np.arange(len(rep)) - np.repeat(np.cumsum(many) - many, many)
        return at[rep], self.passage[entry], self.position[entry]


def windows(at: np.ndarray, position: np.ndarray, length: int, n_words: int) -> list[tuple[int, int, np.ndarray]]:
    """Stretches of a text where a passage of ``length`` words may lie, given its
    hits; each with the diagonals (text minus passage position) of its hits."""
    lo = np.maximum(0, at - position - length // 2 - 1)
    hi = np.minimum(n_words, at - position + length + length // 2 + 1)
    order = np.argsort(lo, kind="stable")
    lo, hi, diag = lo[order], hi[order], (at - position)[order]
    reach = np.maximum.accumulate(hi)
    cut = np.flatnonzero(lo[1:] > reach[:-1]) + 1
    edges = [0, *cut.tolist(), len(lo)]
    return [(int(lo[a]), int(reach[b - 1]), diag[a:b]) for a, b in zip(edges[:-1], edges[1:])]
