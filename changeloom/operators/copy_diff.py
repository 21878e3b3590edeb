"""Differences between two copies of the same tables.

Method: content-defined chunking. Rows are sorted by key; a rolling hash over
the last ``window`` row fingerprints cuts a chunk wherever it meets a condition,
so the cuts depend on the content only and are found again after an insertion
or a deletion. A chunk's fingerprint covers its key range, number of rows and
two combinations of its row hashes. The anti-join of the fingerprints, both ways
at once, leaves the chunks that have no equal on the other side, and only their
rows are compared field by field.

Scale: one plan for every size, with one shuffle and no broadcast of keys. Both
copies are read once; a text field is reduced to a 64-bit hash, the other fields
stay as they are, and these slim rows go to their key block, the same on both
sides. Everything after happens where the rows lie. A key block is ``block``
consecutive numbers of an integer key, or for other and composite keys one of
``rows / block`` hash classes. An over-full block (a key repeated many times) is
found by a count over the keys alone; there are at most ``MAX_FULL`` of them by
their definition. Their exact repeats are removed with map-side combine, and they
are spread by row hash.

Defined results: exact repeats of a row (after normalisation) count once; if a
key still has several different rows on a side, versions equal on both sides
match first and the rest are compared in hash order, a surplus counting as
missing; a null key is a key like any other; null differs from an empty string;
NaN equals NaN; columns outside the plan are ignored; empty tables give missing
rows only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators.ordering import place_in_key, row_numbers
from changeloom.operators.schemas import asof_join
from changeloom.session import materialize

#: Over-full blocks hold at least 1 / MAX_FULL of all rows each.
MAX_FULL = 10_000
#: Where a row is compared: the hash of its block, and of the part of an
#: over-full one. (Two blocks of one hash are sorted and cut together.)
PLACE = "__blk"


@dataclass(frozen=True)
class DiffPlan:
    table: tuple[str, ...] = ("schema_name", "table_name")
    key: tuple[str, ...] = ("id",)
    fields: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    json: tuple[str, ...] = ()
    tolerance: dict[str, float] = field(default_factory=dict)
    window: int = 4
    chunk_rows: int = 16  # expected rows of a chunk
    block: int = 4096
    full: int = 16  # a block of so many times ``block`` rows is over-full

    @property
    def keys(self) -> list[str]:
        return [*self.table, *self.key]


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no spacing; text that is no JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def normalise(df: DataFrame, plan: DiffPlan) -> DataFrame:
    """Keys and fields, without what does not count as a difference."""
    cols = [F.col(c) for c in plan.keys]
    for f in plan.fields:
        c = F.col(f)
        if f in plan.trim:
            c = F.rtrim(c)
        elif f in plan.json:
            c = canonical_json(c)
        cols.append(c.alias(f))
    return df.select(*cols)


def _row_hash(plan: DiffPlan) -> Column:
    """Values with a tolerance are rounded to its grid: equal hashes then mean
    equal within it, and a value next to a grid line at worst makes a chunk be
    compared in full."""
    vals = []
    for f in plan.fields:
        c = F.col(f)
        if f in plan.tolerance:
            cell = F.round(c / F.lit(plan.tolerance[f]))
            # beyond 2^52 cells the grid is finer than the numbers themselves
            c = F.when(F.abs(cell) < float(1 << 52), F.when(cell == 0, F.lit(0.0)).otherwise(cell)).otherwise(c)
        # a null must differ from an absent value: xxhash64 skips nulls
        vals += [c.isNull(), c]
    return F.xxhash64(*plan.keys, *vals)


def slim(df: DataFrame, plan: DiffPlan, side: int) -> DataFrame:
    """Keys, ``__side``, the fields (a text or a nested value as its hash) and
    the row hash ``__h``."""
    rows = normalise(df, plan)
    wide = lambda f: not isinstance(rows.schema[f].dataType, (T.NumericType, T.DatetimeType, T.BooleanType))
    cols = [F.when(F.col(f).isNotNull(), F.xxhash64(f)).alias(f) if wide(f) else F.col(f) for f in plan.fields]
    return rows.select(*plan.keys, F.lit(side).alias("__side"), *cols).withColumn("__h", _row_hash(plan))


def _block(plan: DiffPlan, schema: T.StructType, rows: int) -> Column:
    """Number of the key block, with the table in it."""
    if len(plan.key) == 1 and isinstance(schema[plan.key[0]].dataType, T.IntegralType):
        blk = F.floor(F.col(plan.key[0]) / F.lit(plan.block))
    else:
        blk = F.pmod(F.xxhash64(*plan.key), F.lit(max(1, rows // plan.block)))
    return F.xxhash64(*plan.table, blk.isNull(), blk).alias("__blk")


def place(upstream: DataFrame, downstream: DataFrame, plan: DiffPlan) -> tuple[DataFrame, bool]:
    """Slim rows of both sides, each in its block, and whether any is over-full;
    ``__hot`` marks the rows of such blocks."""
    if upstream.select(*plan.keys).dtypes != downstream.select(*plan.keys).dtypes:
        raise ValueError("the copies have different key types")
    keys = upstream.select(*plan.keys).unionByName(downstream.select(*plan.keys))
    n = keys.count()
    blk = _block(plan, keys.schema, n // 2)
    limit = max(plan.full * plan.block, n // MAX_FULL)
    # by this limit at most MAX_FULL rows of two numbers
    full = keys.groupBy(blk).agg(F.ceil(F.count("*") / F.lit(limit)).cast("int").alias("__parts")).where("__parts > 1")
    full = materialize(full, "full")
    rows = slim(upstream, plan, 0).unionByName(slim(downstream, plan, 1)).withColumn("__blk", blk)
    crowded = not full.isEmpty()
    if crowded:
        marked = rows.join(F.broadcast(full), "__blk", "left")
        hot = marked.where("__parts is not null").dropDuplicates()
        hot = hot.withColumn(PLACE, F.xxhash64(PLACE, F.pmod("__h", F.col("__parts")))).withColumn("__hot", F.lit(True))
        rows = marked.where("__parts is null").withColumn("__hot", F.lit(False)).unionByName(hot).drop("__parts")
    else:
        rows = rows.withColumn("__hot", F.lit(False))
    return rows.repartition(PLACE), crowded


def chunks(rows: DataFrame, plan: DiffPlan) -> DataFrame:
    """The content-defined chunks of each side: place, ``__side``, fingerprint
    (first and last key, number of rows, two combined hashes) and rows."""
    w = Window.partitionBy(PLACE, "__side").orderBy(*plan.keys, "__h")
    again = F.lit(True)
    for c in (*plan.keys, "__h"):
        again = again & F.lag(c).over(w).eqNullSafe(F.col(c))
    rows = rows.withColumn("__again", again & (F.row_number().over(w) > 1)).where("not __again").drop("__again")
    rolling = F.col("__h")
    for i in range(1, plan.window):
        rolling = rolling.bitwiseXOR(F.call_function("shiftleft", F.coalesce(F.lag("__h", i).over(w), F.lit(0)), F.lit(i)))
    rows = rows.withColumn("__cut", (F.pmod(rolling, F.lit(plan.chunk_rows)) == 0).cast("int"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__chunk", F.coalesce(F.sum("__cut").over(before), F.lit(0)))
    key = F.struct(*plan.keys)
    return rows.groupBy(PLACE, "__side", "__chunk").agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count("*").alias("n_rows"),
        F.bit_xor("__h").alias("x1"), F.bit_xor(F.xxhash64("__h", F.lit(1))).alias("x2"),
        F.collect_list(F.struct(*plan.keys, *plan.fields, "__h", "__hot")).alias("rows"),
    )


def unmatched(chunked: DataFrame) -> DataFrame:
    """Chunks whose fingerprint the other side does not have: the anti-join of
    both sides. A side has a fingerprint once, as its rows are distinct."""
    same = Window.partitionBy(PLACE, "first_key", "last_key", "n_rows", "x1", "x2")
    return chunked.withColumn("__sides", F.count("*").over(same)).where("__sides = 1").drop("__sides")


def _differs(f: str, plan: DiffPlan) -> Column:
    a, b = F.col(f"a.{f}"), F.col(f"b.{f}")
    if f in plan.tolerance:
        close = (a == b) | (F.abs(a - b) <= F.lit(plan.tolerance[f] * (1 + 1e-9)))
        return ~F.coalesce(close, a.isNull() & b.isNull())
    return ~a.eqNullSafe(b)


def _pairs(bad: DataFrame, plan: DiffPlan, crowded: bool) -> DataFrame:
    """Rows of unmatched chunks, side ``a`` beside side ``b``. The rows of one key
    are in one block, so normal blocks need no further shuffle; those of an
    over-full one are few after the versions equal on both sides have left, and
    are numbered by a range sort."""
    rows = bad.select(PLACE, "__side", F.inline("rows"))
    rows = rows.groupBy(PLACE, *plan.keys, *plan.fields, "__h", "__hot").agg(F.min("__side").alias("__side"), F.max("__side").alias("__max")).where("__side = __max").drop("__max")

    def beside(d: DataFrame, *at: str) -> DataFrame:
        image = lambda side: F.first(F.when(F.col("__side") == side, F.struct(*plan.fields)), ignorenulls=True)
        return d.groupBy(*at, *plan.keys, "__n").agg(image(0).alias("a"), image(1).alias("b")).select(*plan.keys, "a", "b")

    number = F.row_number().over(Window.partitionBy(PLACE, *plan.keys, "__side").orderBy("__h"))
    pairs = beside((rows.where("not __hot") if crowded else rows).withColumn("__n", number), PLACE)
    if crowded:
        hot = place_in_key(rows.where("__hot"), [*plan.keys, "__side"], [F.col("__h")], "__n")
        pairs = pairs.unionByName(beside(hot))
    return pairs


def diff(upstream: DataFrame, downstream: DataFrame, plan: DiffPlan) -> DataFrame:
    """``table columns, key, diff_kind, field_name``: missing_upstream and
    missing_downstream with an empty field_name, differs once per field."""
    rows, crowded = place(upstream, downstream, plan)
    pairs = _pairs(unmatched(chunks(rows, plan)), plan, crowded)
    kinds = [F.when(_differs(f, plan), F.lit(f)) for f in plan.fields]
    missing = lambda kind: F.array(F.struct(F.lit(kind).alias("kind"), F.lit("").alias("field")))
    found = (
        F.when(F.col("a").isNull(), missing("missing_upstream")).when(F.col("b").isNull(), missing("missing_downstream"))
        .otherwise(F.transform(F.array_compact(F.array(*kinds)), lambda f: F.struct(F.lit("differs").alias("kind"), f.alias("field"))))
    )
    return pairs.select(*plan.keys, F.explode(found).alias("d")).select(*plan.keys, F.col("d.kind").alias("diff_kind"), F.col("d.field").alias("field_name"))


def table_chunks(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``chunk, n_rows, lower, upper, condition``: a table cut into chunks of
    ``size`` rows in key order. Bounds are the key texts of the last row before and
    the last row in a chunk; the condition selects the chunk by a composite key,
    open at both ends of the table."""
    rows = row_numbers(df.select(*keys), [F.col(k) for k in keys], "__no").withColumn("chunk", F.floor((F.col("__no") - 1) / F.lit(size)))
    ends = materialize(rows.groupBy("chunk").agg(F.count("*").alias("n_rows"), F.max(F.struct(*keys)).alias("hi")), "bounds")
    last = ends.agg(F.max("chunk").alias("last"))
    before = ends.select((F.col("chunk") + 1).alias("chunk"), F.col("hi").alias("lo"))
    # one row
    out = ends.join(before, "chunk", "left").join(F.broadcast(last))

    def bound(side: str, op: str, end: str) -> Column:
        """``(a op x) OR (a = x AND b op y)``; the last column is compared by ``end``."""
        parts = []
        for i, k in enumerate(keys):
            same = [F.concat(F.lit(f"`{c}` = "), F.col(f"{side}.{c}").cast("string")) for c in keys[:i]]
            own = F.concat(F.lit(f"`{k}` {end if i == len(keys) - 1 else op} "), F.col(f"{side}.{k}").cast("string"))
            parts.append(F.concat(F.lit("("), F.concat_ws(" AND ", *same, own), F.lit(")")))
        return F.concat(F.lit("("), F.concat_ws(" OR ", *parts), F.lit(")"))

    text = lambda side: F.concat_ws(",", *[F.col(f"{side}.{k}").cast("string") for k in keys])
    lower = F.when(F.col("lo").isNull(), "(TRUE)").otherwise(bound("lo", ">", ">"))
    upper = F.when(F.col("chunk") == F.col("last"), "(TRUE)").otherwise(bound("hi", "<", "<="))
    return out.select("chunk", "n_rows", F.when(F.col("lo").isNotNull(), text("lo")).alias("lower"), text("hi").alias("upper"), F.concat_ws(" AND ", lower, upper).alias("condition"))


def recorded_chunks(chunks: DataFrame, source: str, target: str) -> DataFrame:
    """``schema_name, table_name, chunk_id, lo, hi, state, recorded_equal`` of an
    earlier comparison: the newest row of each chunk and instance. A checksum is
    written in decimal or hexadecimal digits, so two are equal if they are in any
    reading; null if one is missing."""
    last = chunks.groupBy("schema_name", "table_name", "chunk_id", "instance_id").agg(F.max_by(F.struct("chunk_range", "checksum", "state"), F.struct("update_time", "state", "checksum")).alias("x"))
    bound = lambda op: F.regexp_extract("x.chunk_range", rf"`\w+` {op} (-?\d+)", 1).try_cast("bigint")
    text = F.lower(F.trim("x.checksum"))
    readings = F.array_compact(F.array(F.when(text.rlike("^[0-9]+$"), text.try_cast("decimal(20,0)")), F.when(text.rlike("^[0-9a-f]{1,16}$"), F.conv(text, 16, 10).try_cast("decimal(20,0)"))))
    rows = last.select("schema_name", "table_name", "chunk_id", "instance_id", bound(">=").alias("lo"), bound("<").alias("hi"), "x.state", readings.alias("sums"))
    of = lambda which, what: F.max(F.when(F.col("instance_id") == which, F.col(what)))
    both = rows.groupBy("schema_name", "table_name", "chunk_id").agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"), F.coalesce(of(source, "state"), of(target, "state")).alias("state"), of(source, "sums").alias("a"), of(target, "sums").alias("b"))
    known = (F.coalesce(F.size("a"), F.lit(0)) > 0) & (F.coalesce(F.size("b"), F.lit(0)) > 0)
    return both.withColumn("recorded_equal", F.when(known, F.arrays_overlap("a", "b"))).drop("a", "b")


def recheck(found: DataFrame, chunks: DataFrame, upstream: DataFrame, downstream: DataFrame, key: str) -> DataFrame:
    """Adds to each recorded chunk its rows on both sides now, the keys in it that
    differ now, and whether the recorded state still holds. Keys meet their chunk
    by an as-of join on the lower bound."""
    keys = ["schema_name", "table_name"]
    table = F.xxhash64(*keys).alias("tbl")
    rows = upstream.select(*keys, key, F.lit(0).alias("side")).unionByName(downstream.select(*keys, key, F.lit(1).alias("side")))
    rows = rows.unionByName(found.select(*keys, key, F.lit(2).alias("side")).distinct()).where(F.col(key).isNotNull())
    lowest = rows.groupBy(table).agg(F.min(key).alias("least"))
    known = materialize(chunks.withColumn("tbl", table).join(lowest, "tbl", "left"), "recorded")
    spans = known.select("tbl", F.coalesce("lo", F.least("least", F.col("hi") - 1), F.lit(0)).alias("from_ts"), F.col("hi").alias("to_ts"), F.col("chunk_id").alias("version"))
    per = rows.groupBy(table, key, "side").agg(F.count("*").alias("n"))
    placed = asof_join(per, spans, "tbl", key)
    n = lambda side: F.sum(F.when(F.col("side") == side, F.col("n"))).alias(f"n{side}")
    counts = placed.groupBy("tbl", F.col("version").alias("chunk_id")).agg(n(0), n(1), F.count_if(F.col("side") == 2).alias("n2"))
    out = known.join(counts, ["tbl", "chunk_id"], "left").na.fill(0, ["n0", "n1", "n2"])
    return out.select(*keys, "chunk_id", "state", "recorded_equal", F.col("n0").alias("rows_upstream"), F.col("n1").alias("rows_downstream"), F.col("n2").alias("keys_differ"),
                      F.when(F.col("state").isin("success", "failed"), (F.col("state") == "success") == (F.col("n2") == 0)).alias("state_holds"))
