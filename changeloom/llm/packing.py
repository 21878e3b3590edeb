"""Filling fixed-capacity containers with documents.

Method: harmonic packing. Sizes are tokens of a public tokenizer. A piece of
more than C / (j + 1) and at most C / j tokens is of class j, and j pieces of
class j fill a container; each worker packs its own pieces, class by class,
without looking at any other. Pieces below C / ``classes`` (small ones) fill the
room that is left in the worker's containers, largest room first, and then
containers of their own. Only a document above the capacity is split: into full
containers and one rest, which is packed like any other piece.

Pure harmonic packing leaves up to j / (j + 1) of a container unused in low
classes. So, within a worker, the pieces of a class are ordered by size and every
container that is not full after its count takes further pieces of higher
classes that fit (best fit by class), never breaking the capacity. The classes
stay the only search structure: the cost per piece is the number of classes.

Scale: one narrow pass counts tokens; the pieces (id and size only, no text) are
then dealt to ``ceil(pieces / group_rows)`` workers by hash, so a worker has
about ``group_rows`` pieces whatever the input, and no key can be hot. Containers
left open cost at most ``classes`` per worker.

Defined results: null and empty texts have 0 tokens and lie in the first
container of their worker; repeated ids are separate pieces; a tie in size is broken by id; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import os
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.session import materialize


@dataclass(frozen=True)
class PackPlan:
    capacity: int = 8192
    classes: int = 64
    group_rows: int = 50_000
    tokenizer: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"


#: Pattern of the byte-level BPE with 50,257 tokens, a fixed value.
BYTE_BPE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

_ENCODINGS: dict = {}


def encoding(path: str):
    """The tokenizer stored at ``path``, loaded once per worker process."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding(os.path.basename(path), pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def token_counts(documents: DataFrame, plan: PackPlan, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` over whole texts."""

    def run(batches):
        enc = encoding(plan.tokenizer)
        for b in batches:
            sizes = [len(enc.encode_ordinary(t.as_py())) if t.is_valid else 0 for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64())], names=["doc_id", "n_tokens"])

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, n_tokens bigint")


def pieces(counts: DataFrame, capacity: int) -> DataFrame:
    """``doc_id, piece, first_token, n_tokens``: only documents above the capacity
    have more than one piece; all but the last of these are full."""
    last = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.lit(capacity))).cast("int") - 1
    each = counts.select("doc_id", F.explode(F.sequence(F.lit(0), last)).alias("piece"), F.col("n_tokens").alias("total"))
    each = each.withColumn("first_token", F.col("piece").cast("bigint") * capacity)
    return each.select("doc_id", "piece", "first_token", F.least(F.lit(capacity).cast("bigint"), F.col("total") - F.col("first_token")).alias("n_tokens"))


def harmonic_pack(sizes: np.ndarray, capacity: int, classes: int) -> np.ndarray:
    """Container number of each piece; ``sizes`` up to ``capacity``, those of
    nothing lie in container 0."""
    bins = np.zeros(len(sizes), np.int64)
    some = sizes > 0
    bins[some] = _pack_sizes(sizes[some], capacity, classes)
    return bins


def _pack_sizes(sizes: np.ndarray, capacity: int, classes: int) -> np.ndarray:
    kind = np.minimum(capacity // sizes, classes)
    # within a class the largest first
    order = np.lexsort((-sizes, kind))
    queues: list[list[int]] = [[] for _ in range(classes + 1)]
    for i in order[::-1]:
        queues[kind[i]].append(int(i))  # the largest is at the end
    bins = np.zeros(len(sizes), np.int64)
    room: list[tuple[int, int]] = []  # (-room, container) for the small pieces
    n = 0
    size = sizes.tolist()
    for j in range(1, classes):
        q = queues[j]
        while q:
            left = capacity
            for _ in range(j):  # the class's count
                if not q:
                    break
                i = q.pop()
                bins[i] = n
                left -= size[i]
            k = j + 1
            while k < classes:  # what still fits of the higher classes
                other = queues[k]
                # the largest of class k is at the end, the smallest at the start
                if other and size[other[-1]] <= left:
                    i = other.pop()
                    bins[i] = n
                    left -= size[i]
                else:
                    k += 1
            if left:
                room.append((-left, n))
            n += 1
    small = queues[classes]
    heapq.heapify(room)
    for i in reversed(small):
        if room and -room[0][0] >= size[i]:
            left, b = heapq.heappop(room)
            left = -left - size[i]
        else:
            b, left = n, capacity - size[i]
            n += 1
        bins[i] = b
        if left:
            heapq.heappush(room, (-left, b))
    return bins


def pack(documents: DataFrame, plan: PackPlan = PackPlan(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, first_token, n_tokens, worker, container``: the container
    of each piece is named by its worker and its number there."""
    parts = materialize(pieces(token_counts(documents, plan, doc_id, text), plan.capacity), "pieces")
    workers = max(1, -(-parts.count() // plan.group_rows))
    dealt = parts.withColumn("worker", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(workers)).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], ignore_index=True)
        return pdf.assign(container=harmonic_pack(pdf["n_tokens"].to_numpy(np.int64), plan.capacity, plan.classes))

    return dealt.groupBy("worker").applyInPandas(run, "doc_id bigint, piece int, first_token bigint, n_tokens bigint, worker int, container bigint")


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, documents split and the share of room used."""
    bins = packed.groupBy("worker", "container").agg(F.sum("n_tokens").alias("used"))
    return bins.agg(
        F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"),
        (F.sum("used") / (F.count("*") * F.lit(capacity))).alias("fill"),
    )
