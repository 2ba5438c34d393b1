"""Hashed text features and small linear models for the learned operators.

Tokens: the text is lower-cased; a word is a run of ASCII digits or letters and of bytes beyond ASCII.
Features of a text: its distinct words, and the distinct 4- and 5-letter beginnings of its longer words
(so an unseen form of a known stem still counts), hashed into ``BUCKETS`` ids.
"""
from __future__ import annotations

import numpy as np
import xxhash

BUCKETS = 1 << 20
_KEEP = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_KEEP).split()


def distinct_words(text: str) -> set[str]:
    """The distinct words of a text; the empty string may be among them."""
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_KEEP).decode("utf-8", "ignore").split(" "))


class Lexicon:
    """The words and beginnings that a model keeps, by name: a text is met with set operations, and words that
    the model doesn't know (most of a large corpus) are neither hashed nor remembered."""

    def __init__(self, names: list[tuple[int, str, int]]):
        """Rows (0 for a whole word or the length of a beginning, its text, column of the model)."""
        self.by = {n: {s: c for k, s, c in names if k == n} for n in (0, 4, 5)}

    def columns(self, text: str) -> list[int]:
        words = distinct_words(text)
        out = {self.by[0][w] for w in self.by[0].keys() & words}
        for n in (4, 5):
            out.update(self.by[n][w] for w in self.by[n].keys() & {w[:n] for w in words if len(w) > n})
        return sorted(out)


class Hasher:
    """Word -> feature ids, with a cache of bounded size per worker."""

    def __init__(self, buckets: int = BUCKETS, cached: int = 50_000):
        self.buckets, self.cached, self.seen = buckets, cached, {}

    def named(self, w: bytes) -> list[tuple[int, str, int]]:
        """The features of a word: 0 or the length of the beginning, its text, its id."""
        h, b = xxhash.xxh64_intdigest, self.buckets
        s = w.decode("utf-8", "ignore")
        return [(0, s, h(w) % b), *((n, s[:n], h(s[:n].encode(), n) % b) for n in (4, 5) if len(s) > n)]

    def make(self, w: bytes) -> tuple[int, ...]:
        return tuple(f[2] for f in self.named(w))

    def remember(self, w: bytes, value: tuple[int, ...]) -> None:
        if len(self.seen) >= self.cached:
            self.seen.clear()
        self.seen[w] = value

    def word(self, w: bytes) -> tuple[int, ...]:
        ids = self.seen.get(w)
        if ids is None:
            ids = self.make(w)
            self.remember(w, ids)
        return ids

    def known(self, words, kept: dict[int, int]) -> list[int]:
        """Sorted distinct columns of the words' features that a model keeps (id -> column)."""
        out = set()
        for w in set(words):
            cols = self.seen.get(w)
            if cols is None:
                cols = tuple(kept[i] for i in self.make(w) if i in kept)
                self.remember(w, cols)
            out.update(cols)
        return sorted(out)

    def ids(self, words) -> np.ndarray:
        """Sorted distinct feature ids of a collection of words."""
        out = set()
        for w in set(words):
            out.update(self.word(w))
        a = np.fromiter(out, np.int32, len(out))
        a.sort()
        return a


def informative(rows: list[np.ndarray], y: np.ndarray, top: int = 2048, min_rows: int = 5, least: float = 10.8,
                buckets: int = BUCKETS) -> np.ndarray:
    """Ids of the features that tell class 1 from class 0 best, by the chi-square of the 2x2 table: at
    most ``top``, each in ``min_rows`` rows and with a chi-square of ``least`` (p = 0.001)."""
    def counts(some: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate(some) if some else np.empty(0, np.int32), minlength=buckets).astype(float)
    n, n1 = len(y), float(y.sum())
    seen, ones = counts(rows), counts([r for r, of in zip(rows, y) if of])
    ids = np.flatnonzero(seen >= min_rows)
    seen, ones = seen[ids], ones[ids]
    gap = ones * (n - n1) - (seen - ones) * n1
    chi = n * gap ** 2 / np.maximum(seen * (n - seen) * n1 * (n - n1), 1.0)
    best = np.argsort(-chi, kind="stable")[:top]
    return np.sort(ids[best[chi[best] >= least]])


class Sparse:
    """Rows of feature ids (presence) as one flat array of column numbers; only ``kept`` ids count."""

    def __init__(self, rows: list[np.ndarray], kept: np.ndarray, buckets: int = BUCKETS):
        self.kept, self.where = kept, np.full(buckets, -1, np.int32)
        self.where[kept] = np.arange(len(kept))
        at = [self.where[r] for r in rows]             # row by row: only kept features are gathered
        at = [a[a >= 0] for a in at]
        self.own = np.repeat(np.arange(len(rows), dtype=np.int32), [len(a) for a in at])
        self.at = np.concatenate(at) if at else np.empty(0, np.int32)
        self.n_rows, self.n_cols = len(rows), len(kept)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.own, weights=w[self.at], minlength=self.n_rows)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=g[self.own], minlength=self.n_cols)


def adam(grad, w: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam; deterministic."""
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = grad(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w
