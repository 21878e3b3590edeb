"""Interpolated word n-gram models and isotonic regression, in numpy.

The models of all levels share one table of n-gram hashes, so a text is hashed
once and all surprisals come from one lookup per order.
"""

from __future__ import annotations

import math
import re

import numpy as np

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:,]")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_START = "\x02"


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


class Vocabulary:
    """Word numbers; 0 is a word that was not seen."""

    def __init__(self, words):
        self.ids = {w: i + 1 for i, w in enumerate(sorted(words))}

    def encode(self, toks: list[str]) -> np.ndarray:
        get = self.ids.get
        return np.fromiter((get(t, 0) for t in toks), np.uint64, len(toks))


def _grams(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n-gram that ends at a position; before the text stand starts."""
    with np.errstate(over="ignore"):
        pad = np.concatenate([np.full(n - 1, 2**32, np.uint64), ids])
        h = np.zeros(len(ids), np.uint64)
        for k in range(n):
            h = (h ^ (pad[k : k + len(ids)] + np.uint64(1))) * _MIX
            h ^= h >> np.uint64(29)
    return h


class LevelModels:
    """One interpolated model per level: p = sum of l_n p_n, n = order..1, and a
    uniform part for unseen words. The weights follow Witten-Bell."""

    def __init__(self, texts: list[list[str]], levels: list[int], order: int = 3):
        self.order = order
        self.levels = sorted(set(levels))
        self.vocab = Vocabulary({t for x in texts for t in x})
        col = {g: i for i, g in enumerate(self.levels)}
        encoded = [self.vocab.encode(x) for x in texts]
        k = len(self.levels)
        column = np.repeat([col[g] for g in levels], [len(x) for x in encoded])
        self.tables = []
        for n in range(1, order + 1):
            grams = np.concatenate([_grams(ids, n) for ids in encoded])
            heads = np.concatenate([self._contexts(ids, n) for ids in encoded])
            keys, first, at = np.unique(grams, return_index=True, return_inverse=True)
            full = np.bincount(at * k + column, minlength=len(keys) * k).reshape(-1, k).astype(float)
            contexts, of = np.unique(heads, return_inverse=True)
            total = np.bincount(of * k + column, minlength=len(contexts) * k).reshape(-1, k)
            # n-grams of a context that a level has
            kinds = np.zeros((len(contexts), k))
            np.add.at(kinds, of[first], full > 0)
            self.tables.append((self._padded(keys, full), self._padded(contexts, np.hstack([total, kinds]))))

    @staticmethod
    def _contexts(ids: np.ndarray, n: int) -> np.ndarray:
        if n == 1:
            return np.zeros(len(ids), np.uint64)
        shifted = np.concatenate([np.full(1, 2**32, np.uint64), ids[:-1]]) if len(ids) else ids
        return _grams(shifted, n - 1) if n > 1 else shifted

    @staticmethod
    def _padded(keys: np.ndarray, vals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # a last row of zeros stands for n-grams that were not seen
        return keys, np.vstack([vals, np.zeros(vals.shape[1])])

    @staticmethod
    def _lookup(table: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> np.ndarray:
        keys, vals = table
        at = np.searchsorted(keys, h)
        at[at == len(keys)] = 0
        return vals[np.where(keys[at] == h, at, len(keys))]

    def surprisal(self, ids: np.ndarray) -> np.ndarray:
        """Bits of each position (rows) under each level's model (columns)."""
        return self.by_order(ids)[-1]

    def by_order(self, ids: np.ndarray) -> list[np.ndarray]:
        """:meth:`surprisal` of the models interpolated up to each order."""
        out = []
        k = len(self.levels)
        p = np.full((len(ids), k), 1.0 / (len(self.vocab.ids) + 1))
        for n in range(1, self.order + 1):
            full, context = self.tables[n - 1]
            count = self._lookup(full, _grams(ids, n))
            ctx = self._lookup(context, self._contexts(ids, n)).reshape(-1, 2, k)
            total, kinds = ctx[:, 0], ctx[:, 1]
            p = np.where(total > 0, (count + kinds * p) / np.maximum(total + kinds, 1), p)
            out.append(-np.log2(p))
        return out


class LetterModel:
    """Letter trigrams, smoothed by single letters; tells how far a text is from
    the language of the training texts."""

    WORDS = re.compile(r"[^\W\d_]+")

    def __init__(self, texts: list[str], weight: float = 5.0):
        three: dict[str, int] = {}
        two: dict[str, int] = {}
        one: dict[str, int] = {}
        for t in map(self._letters, texts):
            for i in range(2, len(t)):
                three[t[i - 2 : i + 1]] = three.get(t[i - 2 : i + 1], 0) + 1
                two[t[i - 2 : i]] = two.get(t[i - 2 : i], 0) + 1
                one[t[i]] = one.get(t[i], 0) + 1
        total = sum(one.values()) + len(one) + 1
        single = lambda c: (one.get(c, 0) + 1) / total
        self.known = {g: -math.log2((n + weight * single(g[2])) / (two[g[:2]] + weight)) for g, n in three.items()}
        self.after = {g: math.log2((n + weight) / weight) for g, n in two.items()}
        self.alone = {c: -math.log2(single(c)) for c in one}
        self.unknown = math.log2(total)

    def _letters(self, text: str) -> str:
        return " " + " ".join(self.WORDS.findall(text.lower())) + " "

    def bits(self, text: str) -> float:
        """Mean surprisal of a letter; infinite without letters."""
        t = self._letters(text)
        if len(t) < 3:
            return float("inf")
        known, total = self.known.get, 0.0
        for i in range(2, len(t)):
            b = known(t[i - 2 : i + 1])
            total += b if b is not None else self.after.get(t[i - 2 : i], 0.0) + self.alone.get(t[i], self.unknown)
        return total / (len(t) - 2)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots (x, fitted y), both increasing."""
    order = np.argsort(x, kind="stable")
    xs, ys = x[order], y[order].astype(float)
    blocks: list[list[float]] = []  # value, weight, first x, last x
    for a, b in zip(xs, ys):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, _, hi = blocks.pop()
            u = blocks[-1]
            u[0] = (u[0] * u[1] + v * w) / (u[1] + w)
            u[1] += w
            u[3] = hi
    kx = np.array([p for b in blocks for p in (b[2], b[3])])
    ky = np.array([b[0] for b in blocks for _ in range(2)])
    return kx, ky
