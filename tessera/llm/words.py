"""Features of a text's distinct words, hashed: the word, and its first 3 to 6 letters."""

from __future__ import annotations

import re
import zlib

import numpy as np

BITS = 20
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
CACHE_ENTRIES = 100_000


def features(token: str) -> list[int]:
    """Hashed features of one token, without what stands around its letters; none if it has no letter. Words have
    even numbers, beginnings odd ones."""
    word = _EDGES.sub("", token)
    if not word:
        return []
    hashed = lambda x: zlib.crc32(x.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 2)
    return [hashed(f"w {word}")] + [hashed(f"p {word[:n]}") | 1 for n in range(3, 7) if len(word) > n]


class Bags:
    """Texts as triples of row, feature, and how many of the row's distinct tokens have the feature."""

    def __init__(self, n: int, row: np.ndarray, col: np.ndarray, val: np.ndarray):
        self.n, self.row, self.col, self.val = n, row, col, val

    @staticmethod
    def of(texts: list[str]) -> Bags:
        known: dict[str, list[int]] = {}
        return Bags.join([bag(t, known) for t in texts])

    @staticmethod
    def join(bags: list[tuple[np.ndarray, np.ndarray]]) -> Bags:
        """Of each row's features and how often each occurs."""
        rows = [np.full(len(col), i, np.int32) for i, (col, _) in enumerate(bags)]
        joined = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
        return Bags(len(bags), joined(rows, np.int32), joined([c for c, _ in bags], np.int32), joined([v for _, v in bags], np.float32))

    def take(self, rows: np.ndarray) -> Bags:
        """Some of the rows, numbered anew."""
        at = np.full(self.n, -1, np.int32)
        at[rows] = np.arange(len(rows), dtype=np.int32)
        on = at[self.row] >= 0
        return Bags(len(rows), at[self.row[on]], self.col[on], self.val[on])


def bag(text: str, known: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """A whole text's features, in order, and how many of its distinct tokens have each. ``known`` holds tokens seen."""
    ids: list[int] = []
    for t in set(text.lower().split()):
        found = known.get(t)
        if found is None:
            if len(known) >= CACHE_ENTRIES:
                known.clear()
            found = known[t] = features(t)
        ids += found
    col, val = np.unique(np.array(ids, dtype=np.int64), return_counts=True)
    return col.astype(np.int32), val.astype(np.float32)


class TokenWeights(dict):
    """Token -> its row in ``rows``: the sum of its features' weights, for each output."""

    def __init__(self, weights: dict[int, np.ndarray], outputs: int):
        super().__init__()
        self.weights, self.outputs = weights, outputs
        self._clear()

    def _clear(self) -> None:
        self.clear()
        self.rows, self.used, self.seen = np.zeros((64, self.outputs)), 1, 0

    def __missing__(self, token: str) -> int:
        self.seen += 1
        found = [self.weights[f] for f in features(token) if f in self.weights]
        if not found:
            self[token] = 0
            return 0
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = sum(found)
        self[token] = self.used
        self.used += 1
        return self.used - 1

    def score(self, text: str) -> np.ndarray:
        if len(self) > CACHE_ENTRIES:
            self._clear()
        tokens = set(text.lower().split())
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        # Summed in the rows' values' order, so that the same words give the same bits on every worker.
        return np.sort(self.rows[at], axis=0).sum(0)
