"""Evaluation texts leaking into training text.

Method: suffix arrays over shards of the training text. Each task turns its
documents into word numbers, builds a suffix array of every shard (sorted to the
depth of ``min_words`` words, which decides every match) and binary-searches
every suffix of every evaluation item in it. The matches found are lengthened in
both texts to the longest verbatim match, which gives lengths and places.

A word that no item holds cannot be inside a match, so suffixes that meet such a
word before the shortest pattern ends are not sorted; that drops no match.

Scale: the documents are read once, where they lie, without a shuffle; a shard
has at most ``shard_words`` words (one longer document is a shard of its own) and
its words are numbered once. The items are a stated query set: they are compared
in blocks of at most ``block_bytes`` of text, one block at a time in a worker's
memory, all blocks over the same shard. Up to ``scan_blocks`` blocks (256 MB of
items) share a scan of the documents; more items take another scan, so what goes
to the workers is bounded whatever their number.

Defined results: words are maximal runs of a-z and 0-9 in the lower-cased text;
null and empty texts and items without a word match nothing; an item of fewer
than ``min_words`` words must occur whole; repeated rows give equal results,
each pair of ids once per document row; null ids are ids like any other.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class LeakPlan:
    min_words: int = 12
    shard_words: int = 1_000_000
    block_bytes: int = 4 << 20
    scan_blocks: int = 64


class Patterns:
    """All suffixes of a block of items, cut to the length that decides."""

    def __init__(self, ids: list[int | None], texts: list[str], min_words: int):
        words = [WORD.findall((t or "").lower()) for t in texts]
        self.ids = pa.array(ids, pa.int64())
        self.vocab = {w: k + 1 for k, w in enumerate(sorted({w for x in words for w in x}))}
        self.bits = max(1, len(self.vocab).bit_length())
        self.per = max(1, 63 // self.bits)
        self.depth = min_words
        self.columns = -(-min_words // self.per)
        get = self.vocab.__getitem__
        coded = [np.fromiter(map(get, x), np.int64, len(x)) for x in words]
        self.starts = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
        self.words = np.concatenate([*coded, np.zeros(min_words, np.int64)])
        item, place, size = [], [], []
        for k, c in enumerate(coded):
            n = min(len(c), min_words)
            if n:
                at = np.arange(len(c) - n + 1)
                item.append(np.full(len(at), k))
                place.append(at + self.starts[k])
                size.append(np.full(len(at), n))
        self.item = np.concatenate(item) if item else np.zeros(0, np.int64)
        self.place = np.concatenate(place) if place else np.zeros(0, np.int64)
        size = np.concatenate(size) if size else np.zeros(0, np.int64)
        self.shortest = int(size.min()) if len(size) else 0
        # equal patterns are searched once: CSR from pattern to its suffixes
        grams = np.zeros((len(self.place), min_words + 1), np.int64)
        for k in range(min_words):
            grams[:, k] = np.where(k < size, self.words[self.place + np.minimum(k, np.maximum(size - 1, 0))], 0)
        grams[:, -1] = size
        unique, owner = np.unique(grams, axis=0, return_inverse=True) if len(grams) else (grams, np.zeros(0, np.int64))
        owner = owner.ravel()
        self.by_pattern = np.argsort(owner, kind="stable")
        self.offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(unique)))]).astype(np.int64)
        self.low = self._pack(unique[:, :-1], unique[:, -1], False)
        self.high = self._pack(unique[:, :-1], unique[:, -1], True)

    def _pack(self, grams: np.ndarray, size: np.ndarray, top: bool) -> list[np.ndarray]:
        """Sort keys of the first (or last) suffix that has the pattern as prefix."""
        out = []
        most = (1 << self.bits) - 1
        for c in range(self.columns):
            key = np.zeros(len(grams), np.int64)
            for t in range(self.per):
                k = c * self.per + t
                w = np.where(k < size, grams[:, k], most if top else 0) if k < self.depth else np.full(len(grams), most if top else 0)
                key = (key << self.bits) | w
            out.append(key)
        return out


class Shard:
    """Suffix array over the words of some documents; 0 ends a document and
    stands for words that no item has."""

    def __init__(self, p: Patterns, docs: list[np.ndarray]):
        self.p = p
        zero = np.zeros(1, np.int64)
        self.words = np.concatenate([x for d in docs for x in (d, zero)] + [np.zeros(p.depth + p.per, np.int64)])
        self.doc_start = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])]).astype(np.int64)
        known = np.flatnonzero(self.words)
        gaps = np.flatnonzero(self.words == 0)
        run = gaps[np.searchsorted(gaps, known)] - known if len(known) else known
        place = known[run >= p.shortest] if p.shortest else known[:0]
        keys = []
        for c in range(p.columns):
            key = np.zeros(len(place), np.int64)
            for t in range(p.per):
                k = c * p.per + t
                key = (key << p.bits) | (self.words[place + k] if k < p.depth else 0)
            keys.append(key)
        order = np.lexsort(keys[::-1]) if len(place) else place
        self.array = place[order]
        self.keys = [k[order] for k in keys]

    def _bound(self, pattern: list[np.ndarray], right: bool) -> np.ndarray:
        n = len(self.array)
        lo, hi = np.zeros(len(pattern[0]), np.int64), np.full(len(pattern[0]), n, np.int64)
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            at = np.minimum(mid, n - 1)
            less = np.zeros(len(mid), bool)
            tie = np.ones(len(mid), bool)
            for key, p in zip(self.keys, pattern):
                x = key[at]
                less |= tie & (x < p)
                tie &= x == p
            if right:
                less |= tie
            go = lo < hi
            lo = np.where(go & less, mid + 1, lo)
            hi = np.where(go & ~less, mid, hi)
        return lo

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, place in the shard) of every occurrence."""
        if not len(self.array) or not len(self.p.low[0]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo, hi = self._bound(self.p.low, False), self._bound(self.p.high, True)
        n = np.maximum(hi - lo, 0)
        hit = np.flatnonzero(n)
        at = np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(n[hit])[:-1]]), n[hit]) + np.arange(n[hit].sum())
        return np.repeat(hit, n[hit]), self.array[at]

    def _owners(self, pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row number of each pattern repeated per item suffix, and the suffix."""
        first, n = self.p.offsets[pattern], self.p.offsets[pattern + 1] - self.p.offsets[pattern]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else n
        return np.repeat(np.arange(len(pattern)), n), self.p.by_pattern[at]

    def leaks(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document number, item number)."""
        pattern, place = self.occurrences()
        doc = np.searchsorted(self.doc_start, place, "right") - 1
        pairs = np.unique(np.stack([pattern, doc], 1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
        row, suffix = self._owners(pairs[:, 0])
        out = np.unique(np.stack([pairs[row, 1], self.p.item[suffix]], 1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
        return out[:, 0], out[:, 1]

    def longest(self) -> np.ndarray:
        """Per (document, item) the longest verbatim match: columns document,
        item, words, first word in the document, first word in the item."""
        pattern, place = self.occurrences()
        row, suffix = self._owners(pattern)
        place, item = place[row], self.p.item[suffix]
        doc = np.searchsorted(self.doc_start, place, "right") - 1
        inside = self.p.place[suffix]
        end = self.p.starts[item + 1]
        a, b = place.copy(), inside.copy()
        live = np.arange(len(a))
        while len(live):  # lengthen all matches at once, until the last one ends
            ok = (b[live] < end[live]) & (self.words[a[live]] == self.p.words[b[live]]) & (self.words[a[live]] > 0)
            live = live[ok]
            a[live] += 1
            b[live] += 1
        out = np.stack([doc, item, a - place, place - self.doc_start[doc], inside - self.p.starts[item]], 1)
        out = out[np.lexsort((out[:, 4], out[:, 3], -out[:, 2], out[:, 1], out[:, 0]))]
        first = np.ones(len(out), bool)
        first[1:] = (out[1:, :2] != out[:-1, :2]).any(1)
        return out[first]


def _blocks(items: DataFrame, item_id: str, text: str, limit: int):
    """The items in bounded blocks, one at a time on the driver."""
    size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = -(-size // limit) or 1
    for k in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64(item_id, text), F.lit(n)) == k)
        rows = block.select(F.col(item_id).cast("bigint"), text).where(F.col(text).isNotNull()).collect()
        if rows:
            yield [r[0] for r in rows], [r[1] for r in rows]


def _scans(items: DataFrame, item_id: str, text: str, plan: LeakPlan):
    """The broadcast blocks of each scan of the documents."""
    held = []
    for ids, texts in _blocks(items, item_id, text, plan.block_bytes):
        held.append(items.sparkSession.sparkContext.broadcast(Patterns(ids, texts, plan.min_words)))
        if len(held) == plan.scan_blocks:
            yield held
            held = []
    if held:
        yield held


def _shards(batches, at: int, limit: int):
    """Record batches, cut at shard ends, with the word numbers of each of their
    documents and the numbered words."""
    held, coded, total, numbers = [], [], 0, {}
    for b in batches:
        start = 0
        for i, t in enumerate(b.column(at)):
            words = WORD.findall(t.as_py().lower()) if t.is_valid else ()
            if total and total + len(words) > limit:
                if i > start:
                    held.append(b.slice(start, i - start))
                yield held, coded, numbers
                held, coded, total, numbers, start = [], [], 0, {}, i
            put = numbers.setdefault
            coded.append(np.fromiter((put(w, len(numbers)) for w in words), np.int64, len(words)))
            total += len(words)
        if b.num_rows > start:
            held.append(b.slice(start))
    if held:
        yield held, coded, numbers


def _searched(blocks: list, coded: list[np.ndarray], numbers: dict[str, int]):
    """The shard under the patterns of each block in turn."""
    for shared in blocks:
        p = shared.value
        known = np.fromiter((p.vocab.get(w, 0) for w in numbers), np.int64, len(numbers))
        yield p, Shard(p, [known[c] for c in coded])
        if len(blocks) > 1:  # one block in memory at a time; it is loaded again from the worker's disk
            shared.__dict__.pop("_value", None)


def _scan(documents: DataFrame, items: DataFrame, plan: LeakPlan, doc_id: str, item_id: str, text: str, item_text: str, full: bool) -> DataFrame:
    spark = documents.sparkSession
    names = ["doc_id", "item_id", *(["n_words", "doc_word", "item_word"] if full else [])]
    schema = ", ".join(f"{n} bigint" for n in names)
    docs = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    out = spark.createDataFrame([], schema)
    for n, blocks in enumerate(_scans(items, item_id, item_text, plan)):

        def run(batches, blocks=blocks):
            for held, coded, numbers in _shards(batches, 1, plan.shard_words):
                keys = pa.chunked_array([b.column(0) for b in held])
                for p, shard in _searched(blocks, coded, numbers):
                    if full:
                        m = shard.longest()
                        doc, item, rest = m[:, 0], m[:, 1], [pa.array(m[:, k], pa.int64()) for k in (2, 3, 4)]
                    else:
                        (doc, item), rest = shard.leaks(), []
                    yield pa.record_batch([keys.take(pa.array(doc)).combine_chunks(), p.ids.take(pa.array(item)), *rest], names=names)

        part = docs.mapInArrow(run, schema)
        out = out.unionByName(part) if n else part
    return out


def leaked(documents: DataFrame, items: DataFrame, plan: LeakPlan = LeakPlan(), doc_id="doc_id", item_id="item_id", text="text", item_text="item_text") -> DataFrame:
    """``doc_id, item_id``: the document holds ``min_words`` consecutive words of
    the item, or all its words if it has fewer."""
    return _scan(documents, items, plan, doc_id, item_id, text, item_text, False)


def longest_matches(documents: DataFrame, items: DataFrame, plan: LeakPlan = LeakPlan(), doc_id="doc_id", item_id="item_id", text="text", item_text="item_text") -> DataFrame:
    """:func:`leaked` with the longest match of each pair: number of words and
    the number of its first word in the document and in the item (from 0)."""
    return _scan(documents, items, plan, doc_id, item_id, text, item_text, True)


def without_leaks(documents: DataFrame, items: DataFrame, plan: LeakPlan = LeakPlan(), item_id="item_id", text="text", item_text="item_text") -> DataFrame:
    """The documents that hold no passage of any item, with all their columns.
    They are searched and passed on in one step, row by row, so neither null nor
    repeated ids matter and nothing is joined."""
    at = documents.columns.index(text)
    for blocks in _scans(items, item_id, item_text, plan):

        def run(batches, blocks=blocks):
            for held, coded, numbers in _shards(batches, at, plan.shard_words):
                keep = np.ones(len(coded), bool)
                for _, shard in _searched(blocks, coded, numbers):
                    keep[shard.leaks()[0]] = False
                for b in held:
                    mask, keep = keep[: b.num_rows], keep[b.num_rows :]
                    yield b.filter(pa.array(mask))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
