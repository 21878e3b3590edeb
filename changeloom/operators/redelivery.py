"""Messages delivered more than once.

Method. Identifiers fall into time buckets; a repeat has the same time, hence
the same bucket. Each bucket has a blocked Bloom filter of 32,768-bit blocks
(``bitmap_construct_agg``), whose bits mark the positions that were hit more
than once. A row with a clear bit among its positions is certainly the only one
of its kind and leaves at once; the others are verified exactly, by their full
identifiers, against the rows of the same bucket only.

Scale: one plan for every size. The time span is cut into at most
``max_buckets`` buckets, so the table of bucket sizes is bounded and may be
broadcast; a fuller bucket gets more blocks. Hits are counted with map-side
combine. Rows meet their filter by (bucket, block) in one sort-merge join; a
block that is over-full (many copies of one identifier) is salted, and there are
at most ``MAX_FULL`` such blocks by their definition. The exact check combines on
the map side. No filter is broadcast.

Defined results: nulls in identifiers compare equal to each other; rows without
a time share the bucket -1; an empty table gives an empty result; of copies with
one ``order`` any is kept.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.session import materialize, read_text, remove_path, work_path, write_text

BLOCK_BITS = 32768
#: Over-full blocks hold at least 1 / MAX_FULL of all rows each.
MAX_FULL = 10_000


@dataclass(frozen=True)
class BloomPlan:
    bucket_ms: int = 3_600_000
    max_buckets: int = 4096
    bits_per_key: int = 16
    hashes: int = 2
    full: int = 16  # a block of so many times its share of rows is over-full

    @property
    def per_block(self) -> int:
        return BLOCK_BITS // self.bits_per_key


def _position(h: Column, i: int) -> Column:
    """Bit number ``i`` of an identifier hash within its block."""
    return F.pmod(F.shiftrightunsigned(h, 17 * i + 14), F.lit(BLOCK_BITS)).cast("int")


def _bit(bits: Column, pos: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(pos, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, pos.bitwiseAND(7)).bitwiseAND(1) == 1


def _hit(bits: Column, h: Column, hashes: int) -> Column:
    """All positions of the hash are set; false without a filter."""
    hit = bits.isNotNull()
    for i in range(hashes):
        hit = hit & _bit(bits, _position(h, i))
    return F.coalesce(hit, F.lit(False))


def _positions(h: Column, hashes: int) -> Column:
    return F.explode(F.array(*[_position(h, i) for i in range(hashes)])).alias("__pos")


def _free(name: str, taken: list[str]) -> str:
    """``name``, with ``_`` before it as long as a column has it."""
    while name in taken:
        name = f"_{name}"
    return name


class Screen:
    """Repeat filters of one set of identifiers, and the place of a row in them."""

    def __init__(self, df: DataFrame, ids: dict[str, Column], ts_ms: Column, plan: BloomPlan):
        self.ids, self.ts_ms, self.plan = ids, ts_ms, plan
        # the bucketed storage: identifiers with hash and time, in time order within each file
        keyed = df.select(*[c.alias(n) for n, c in ids.items()], *self._base(ids, ts_ms))
        self.store = materialize(keyed.sortWithinPartitions("__ms"), "ids")
        n, lo, hi = self.store.agg(F.count("*"), F.min(F.when(F.col("__ms") >= 0, F.col("__ms"))), F.max("__ms")).first()
        most = max(1, min(plan.max_buckets - 2, n // (4 * plan.per_block)))
        self.width = max(plan.bucket_ms, -(-(max(0, (hi or 0) - (lo or 0)) + 1) // most))
        sizes = self.store.groupBy(self._bucket()).agg(F.ceil(F.count("*") / F.lit(plan.per_block)).cast("int").alias("__blocks"))
        self.sizes = materialize(sizes, "sizes")  # at most max_buckets rows of two numbers
        placed = self._in_block(self.store)
        hits = placed.select("__bucket", "__block", _positions(F.col("__h"), plan.hashes))
        counted = hits.groupBy("__bucket", "__block", "__pos").count().groupBy("__bucket", "__block").agg(
            F.expr("bitmap_construct_agg(CASE WHEN count > 1 THEN __pos END)").alias("__bits"), F.sum("count").alias("__hits"))
        self.filters = materialize(counted, "bloom")
        limit = max(plan.full * plan.per_block, n // MAX_FULL)
        # by this limit at most MAX_FULL rows of three numbers
        full = self.filters.select("__bucket", "__block", F.ceil(F.col("__hits") / F.lit(plan.hashes * limit)).cast("int").alias("__salts"))
        self.full = full.where("__salts > 1")

    @staticmethod
    def _base(ids: dict[str, Column], ts_ms: Column) -> list[Column]:
        return [F.coalesce(ts_ms, F.lit(-1)).cast("bigint").alias("__ms"), F.xxhash64(*ids.values()).alias("__h")]

    def _bucket(self) -> Column:
        return F.when(F.col("__ms") >= 0, F.floor(F.col("__ms") / F.lit(self.width))).otherwise(-1).cast("bigint").alias("__bucket")

    def _in_block(self, keyed: DataFrame) -> DataFrame:
        rows = keyed.withColumn("__bucket", self._bucket())
        return rows.join(F.broadcast(self.sizes), "__bucket").withColumn("__block", F.pmod(F.col("__h"), F.col("__blocks")).cast("int")).drop("__blocks")

    def mark(self, keyed: DataFrame) -> DataFrame:
        """Adds ``__bucket`` and ``__maybe``: false for rows that certainly have no copy."""
        rows = self._in_block(keyed).join(F.broadcast(self.full), ["__bucket", "__block"], "left")
        rows = rows.withColumn("__salt", F.when(F.col("__salts").isNotNull(), F.floor(F.rand(11) * F.col("__salts"))).otherwise(0).cast("int")).drop("__salts")
        salted = self.filters.drop("__hits").join(F.broadcast(self.full), ["__bucket", "__block"], "left")
        salted = salted.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__salts")
        joined = rows.join(salted.hint("merge"), ["__bucket", "__block", "__salt"], "left")
        return joined.withColumn("__maybe", _hit(F.col("__bits"), F.col("__h"), self.plan.hashes)).drop("__bits", "__salt", "__block")


def repeated_messages(df: DataFrame, ids: dict[str, Column], ts_ms: Column, plan: BloomPlan = BloomPlan()) -> DataFrame:
    """Each identifier held more than once, with its number of copies."""
    screen = Screen(df, ids, ts_ms, plan)
    maybe = screen.mark(screen.store).where("__maybe")
    return maybe.groupBy("__bucket", *ids).agg(F.count("*").alias("copies")).where("copies > 1").select(*ids, "copies")


def exactly_once(df: DataFrame, ids: dict[str, Column], ts_ms: Column, order: str, plan: BloomPlan = BloomPlan()) -> DataFrame:
    """The messages, one row of each with all its columns: of several copies the
    one of smallest ``order`` (nulls last), and ``copies``. Only possible repeats
    are grouped. Columns of ``df`` keep their names; ``copies`` gives way."""
    copies = _free("copies", df.columns)
    screen = Screen(df, ids, ts_ms, plan)
    names = [f"__id{i}" for i in range(len(ids))]
    keyed = df.select(F.struct("*").alias("__row"), F.col(order).alias("__order"), *[c.alias(n) for c, n in zip(ids.values(), names)], *screen._base(ids, ts_ms))
    marked = screen.mark(keyed)
    single = marked.where("not __maybe").select("__row.*", F.lit(1).cast("bigint").alias(copies))
    first = F.min_by("__row", F.struct(F.col("__order").isNull(), "__order")).alias("__row")
    checked = marked.where("__maybe").groupBy("__bucket", *names).agg(first, F.count("*").alias(copies))
    return single.unionByName(checked.select("__row.*", copies))


class RedeliveryStore:
    """Exactly-once filter over many batches, for ``foreachBatch``.

    Below ``path`` lie ``ids/bucket=B/version=N``, the identifiers accepted in
    batch N, ``bloom/version=N``, the whole filter of each bucket that batch N
    changed, and ``meta/N``, for every kept bucket the version of its filter and
    its numbers of identifiers and blocks (at most ``max_buckets`` entries). A
    batch reads the meta file of the batch before, the newest filter of its own
    buckets, and the stored identifiers of those buckets that hold a possible
    repeat; it writes its own version only, so a batch that is run again changes
    nothing.

    A bucket whose identifiers outgrow its filter gets twice the blocks, made
    again from its stored identifiers. With ``keep_buckets`` buckets that far
    behind the newest are forgotten: their rows come out with ``checked`` false,
    as they can be held against their own batch only.
    """

    def __init__(self, spark: SparkSession, ids: list[str], ts_ms: str, path: str | None = None, bucket_ms: int = 3_600_000, plan: BloomPlan = BloomPlan(), keep_buckets: int | None = None):
        self.spark, self.ids, self.ts_ms, self.plan = spark, ids, ts_ms, plan
        self.path = path or work_path(spark, "redelivery")
        self.bucket_ms, self.keep = bucket_ms, keep_buckets
        if keep_buckets and keep_buckets > plan.max_buckets:
            raise ValueError("keep_buckets is above max_buckets")

    def _meta(self, batch_id: int) -> dict[int, tuple[int, int, int]]:
        text = read_text(self.spark, f"{self.path}/meta/{batch_id}")
        return {int(b): tuple(x) for b, x in json.loads(text).items()} if text else {}

    def _filters(self, meta: dict, buckets: list[int]) -> DataFrame | None:
        versions = sorted({meta[b][0] for b in buckets})
        if not versions:
            return None
        rows = self.spark.read.schema("__block int, __bits binary, version bigint, bucket bigint").parquet(f"{self.path}/bloom")
        newest = self._numbers({b: meta[b][0] for b in buckets}, "version")
        return rows.where(F.col("bucket").isin(buckets) & F.col("version").isin(versions)).join(newest, ["bucket", "version"], "left_semi")

    def _numbers(self, values: dict[int, int], name: str) -> DataFrame:
        """A number per bucket, at most ``max_buckets`` rows."""
        return F.broadcast(self.spark.createDataFrame(list(values.items()), f"bucket bigint, {name} bigint"))

    def stored(self, buckets: list[int], before: int, types: str) -> DataFrame | None:
        """Identifiers of these buckets: only their folders are listed and read."""
        if not buckets:
            return None
        rows = self.spark.read.schema(f"{types}, bucket bigint, version bigint").option("basePath", f"{self.path}/ids").parquet(*[f"{self.path}/ids/bucket={b}" for b in buckets])
        return rows.where(F.col("version") < before)

    def process(self, batch: DataFrame, batch_id: int, order: str | None = None) -> DataFrame:
        """The rows of ``batch`` whose identifier no earlier batch held, one of
        each (that of smallest ``order``, else any), with ``checked``."""
        meta = self._meta(batch_id - 1)
        bucket = F.coalesce(F.floor(F.col(self.ts_ms) / F.lit(self.bucket_ms)), F.lit(-1)).cast("bigint")
        rows = batch.select(F.struct("*").alias("__row"), *[F.col(c) for c in self.ids], bucket.alias("bucket"), F.xxhash64(*self.ids).alias("__h"))
        at = F.struct(F.col(f"__row.{order}").isNull(), F.col(f"__row.{order}")) if order else F.lit(0)
        new = materialize(rows.groupBy("bucket", *self.ids, "__h").agg(F.min_by("__row", at).alias("__row")), "batch")
        counts = {r[0]: r[1] for r in new.groupBy("bucket").count().limit(self.plan.max_buckets + 1).collect()}
        if len(counts) > self.plan.max_buckets:
            raise ValueError(f"the batch spans more than {self.plan.max_buckets} buckets of {self.bucket_ms} ms")
        newest = max([*meta, *counts], default=0)
        gone = lambda b: self.keep is not None and 0 <= b <= newest - self.keep
        types = ", ".join(f"`{c}` {batch.schema[c].dataType.simpleString()}" for c in self.ids)
        kept, known = new.withColumn("checked", F.lit(True)), [b for b in counts if b in meta]
        if (filters := self._filters(meta, known)) is not None:
            blocks = self._numbers({b: meta[b][2] for b in known}, "__blocks")
            placed = new.join(blocks, "bucket", "left").withColumn("__block", F.pmod(F.col("__h"), F.col("__blocks")).cast("int")).drop("__blocks")
            hit = _hit(F.col("__bits"), F.col("__h"), self.plan.hashes)
            marked = materialize(placed.join(filters.drop("version"), ["bucket", "__block"], "left").withColumn("__maybe", hit).drop("__bits", "__block"), "screened")
            suspect = [r[0] for r in marked.where("__maybe").select("bucket").distinct().collect()]  # some of the counted buckets
            stored = self.stored(suspect, batch_id, types)
            if stored is not None:
                maybe, s = marked.where("__maybe").alias("m"), stored.alias("s")
                same = F.col("m.bucket") == F.col("s.bucket")
                for c in self.ids:
                    same = same & F.col(f"m.{c}").eqNullSafe(F.col(f"s.{c}"))
                marked = marked.where("not __maybe").unionByName(maybe.join(s, same, "left_anti"))
            kept = materialize(marked.drop("__maybe").withColumn("checked", F.lit(True)), "accepted")
        old = [b for b in counts if gone(b)]
        if old:
            kept = kept.withColumn("checked", ~F.col("bucket").isin(old))
        accepted = kept.where("checked").select(*self.ids, "bucket", "__h")
        self._store(accepted, meta, {b: n for b, n in counts.items() if not gone(b)}, batch_id, types, gone)
        return kept.select("__row.*", F.col("checked").alias(_free("checked", batch.columns)))

    def _store(self, accepted: DataFrame, meta: dict, counts: dict[int, int], batch_id: int, types: str, gone) -> None:
        write = lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version")
        version = F.lit(batch_id).cast("bigint").alias("version")
        write(accepted.drop("__h").select("*", version).repartition("bucket")).parquet(f"{self.path}/ids")
        added = {r[0]: r[1] for r in accepted.groupBy("bucket").count().collect()}  # counted buckets only
        after = {b: x for b, x in meta.items() if not gone(b)}
        grown, same = [], []
        for b, n in added.items():
            have, blocks = (after[b][1], after[b][2]) if b in after else (0, 0)
            need = blocks or 1
            while need * self.plan.per_block < have + n:
                need *= 2
            (grown if have and need > blocks else same).append(b)
            after[b] = (batch_id, have + n, need)
        hashed = accepted.select("bucket", "__h")
        if grown:
            hashed = hashed.unionByName(self.stored(grown, batch_id, types).select("bucket", F.xxhash64(*self.ids).alias("__h")))
        if added:
            sized = hashed.join(self._numbers({b: after[b][2] for b in added}, "__blocks"), "bucket")
            put = sized.select("bucket", F.pmod(F.col("__h"), F.col("__blocks")).cast("int").alias("__block"), _positions(F.col("__h"), self.plan.hashes))
            bits = put.groupBy("bucket", "__block").agg(F.expr("bitmap_construct_agg(__pos)").alias("__bits"))
            before = self._filters(meta, [b for b in same if b in meta])
            if before is not None:
                bits = bits.unionByName(before.select("bucket", "__block", "__bits")).groupBy("bucket", "__block").agg(F.expr("bitmap_or_agg(__bits)").alias("__bits"))
            bits.select("bucket", "__block", "__bits").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/bloom/version={batch_id}")
        write_text(self.spark, f"{self.path}/meta/{batch_id}", json.dumps({str(b): x for b, x in after.items()}))
        # what no batch will read again: forgotten buckets, older filters and meta files
        for b in meta:
            if gone(b):
                remove_path(self.spark, f"{self.path}/ids/bucket={b}")
        for v in {x[0] for x in self._meta(batch_id - 2).values()} - {x[0] for m in (meta, after) for x in m.values()}:
            remove_path(self.spark, f"{self.path}/bloom/version={v}")
        remove_path(self.spark, f"{self.path}/meta/{batch_id - 2}")
