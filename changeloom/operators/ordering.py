"""Order of changes and transactions.

A transaction is (commit_ts, start_ts); inside it deletes come before updates
and updates before inserts, then the key decides. Ordering is a range-partitioned
sort; numbers over the whole log are offsets per partition plus the place in it,
never a window over one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.session import materialize

TXN = ["commit_ts", "start_ts"]
#: Rows of one block of an ordered pass.
BLOCK_ROWS = 65_536
#: Rows from which a key is ordered in blocks, and the most keys of which this holds.
HOT_ROWS, MAX_HOT = 16 * BLOCK_ROWS, 1000


def op_order(op: str = "op") -> Column:
    return F.when(F.col(op) == "D", 0).when(F.col(op) == "U", 1).when(F.col(op) == "I", 2)


def txn_order(keys: list[str]) -> list[Column]:
    return [F.col("commit_ts"), F.col("start_ts"), op_order(), *[F.col(k) for k in keys]]


def total_order(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy(*txn_order(keys))


def row_numbers(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """Number of each row in a total order, from 1, over any number of tasks."""
    names = [f"__o{i}" for i in range(len(order))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(order, names)])
    placed = keyed.repartitionByRange(*names).sortWithinPartitions(*names).drop(*names)
    # the number holds the partition above bit 33 and the place in it below
    stored = materialize(placed.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return (
        stored.withColumn("__part", part).join(F.broadcast(offsets), "__part")
        .withColumn(name, place + F.col("__before") + 1).drop("__at", "__part", "__before")
    )


def transactions(df: DataFrame) -> DataFrame:
    """``commit_ts, start_ts, n_rows, txn_no``: transactions in commit order."""
    return row_numbers(df.groupBy(*TXN).agg(F.count("*").alias("n_rows")), [F.col(c) for c in TXN], "txn_no")


def same_keys(keys: list[str], prefix: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def _minus_first(rows: DataFrame, keys: list[str], number: str, name: str) -> DataFrame:
    """``name`` = ``number`` less its smallest value within the key."""
    first = rows.groupBy(*keys).agg(F.min(number).alias("__first_no")).withColumnsRenamed({k: f"__k_{k}" for k in keys})
    out = rows.join(first, same_keys(keys, "__k_"))
    return out.withColumn(name, F.col(number) - F.col("__first_no")).drop("__first_no", *[f"__k_{k}" for k in keys])


def split_hot(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """``(rows of normal keys, rows of hot keys)``, stored once. A key is hot with
    ``HOT_ROWS`` rows and a ``1 / MAX_HOT`` share of all, so there are at most
    ``MAX_HOT``; without one the second part is None. A key's rows fit a window of
    one task below that, and are ordered in blocks over many tasks above it."""
    rows = materialize(df, "keyed")
    total = rows.count()
    if total < HOT_ROWS:
        return rows, None
    hot = rows.groupBy(*keys).count().where(F.col("count") >= max(HOT_ROWS, total // MAX_HOT)).select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    hot = materialize(hot, "hot")
    if hot.isEmpty():
        return rows, None
    # at most MAX_HOT keys
    return rows.join(F.broadcast(hot), same_keys(keys, "__k_"), "left_anti"), rows.join(F.broadcast(hot), same_keys(keys, "__k_"), "left_semi")


def place_in_key(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Place of each row within its key, from 0. For a hot key it is the row's
    number in the whole order less the key's first."""
    rows, hot = split_hot(df, keys)
    out = rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint") - 1)
    if hot is None:
        return out
    numbered = row_numbers(hot, [*[F.col(k) for k in keys], *order], "__no")
    return out.unionByName(_minus_first(numbered, keys, "__no", name).drop("__no"))


def _previous_in_window(rows: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = rows.withColumn("is_first", F.row_number().over(w) == 1)
    return rows.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns})


def _previous_in_blocks(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """The order is a range sort over all rows, cut into blocks of numbers, and
    the last row of a block is copied into the next. Leaves the row's number
    ``__no`` and its block ``__blk``."""
    rows = row_numbers(df, [*[F.col(k) for k in keys], *order], "__no")
    own = F.floor((F.col("__no") - 1) / F.lit(BLOCK_ROWS))
    halo = F.when(F.col("__no") % BLOCK_ROWS == 0, F.array(own, own + 1)).otherwise(F.array(own))
    rows = rows.withColumn("__own", own).withColumn("__blk", F.explode(halo))
    w = Window.partitionBy("__blk").orderBy("__no")
    same = F.row_number().over(w) > 1
    for k in keys:
        same = same & F.lag(k).over(w).eqNullSafe(F.col(k))
    rows = rows.withColumn("is_first", ~same)
    for c in columns:
        rows = rows.withColumn(f"prev_{c}", F.when(~F.col("is_first"), F.lag(c).over(w)))
    return rows.where("__blk = __own").drop("__own")


def with_previous(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Adds ``prev_<column>`` of the row before within the key (null for the
    first) and ``is_first``."""
    rows, hot = split_hot(df, keys)
    out = _previous_in_window(rows, keys, order, columns)
    return out if hot is None else out.unionByName(_previous_in_blocks(hot, keys, order, columns).drop("__no", "__blk"))


def runs(df: DataFrame, keys: list[str], order: list[Column], columns: list[str], starts: Column) -> list[DataFrame]:
    """:func:`with_previous` with ``__run``, the number of the row's run, which
    begins where ``starts`` is true: counted from 0 in the first frame, over all
    keys in the second (that of the hot keys, if there are any)."""
    rows, hot = split_hot(df, keys)
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = [_previous_in_window(rows, keys, order, columns).withColumn("__run", F.sum(starts.cast("bigint")).over(w) - 1)]
    if hot is not None:
        out.append(running_flags(_previous_in_blocks(hot, keys, order, columns), starts, "__run").drop("__no", "__blk"))
    return out


def numbered_blocks(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds the row's number ``__no`` in the order of keys and ``order`` and its
    block ``__blk``."""
    rows = row_numbers(df, [*[F.col(k) for k in keys], *order], "__no")
    return rows.withColumn("__blk", F.floor((F.col("__no") - 1) / F.lit(BLOCK_ROWS)))


def _before(rows: DataFrame, keys: list[str], value: str, name: str, total) -> DataFrame:
    """``total`` (a maximum or a sum) over the key's earlier rows, over rows of
    :func:`numbered_blocks`: inside the block and, from one row per key and block,
    over the blocks before. Null where there is nothing."""
    blocks = rows.groupBy(*keys, "__blk").agg(total(value).alias("__m"))
    w = Window.partitionBy(*keys).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__blk").alias("__b"), total("__m").over(w).alias("__carried"))
    inside = Window.partitionBy(*keys, "__blk").orderBy("__no").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("__inside", total(value).over(inside)).join(carried, same_keys(keys, "__k_") & (F.col("__blk") == F.col("__b")))
    both = F.greatest("__inside", "__carried") if total is F.max else F.coalesce(F.col("__inside") + F.col("__carried"), "__inside", "__carried")
    return out.withColumn(name, both).drop("__inside", "__carried", "__b", *[f"__k_{k}" for k in keys])


def max_before(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Largest value of the key's earlier rows (null for the first)."""
    return _before(rows, keys, value, name, F.max)


def _by_key(df: DataFrame, keys: list[str], order: list[Column], cold, hot) -> DataFrame:
    """``cold(rows, window of the earlier rows)`` for normal keys, ``hot(numbered
    rows)`` for hot ones."""
    rows, crowded = split_hot(df, keys)
    out = cold(rows, Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    if crowded is None:
        return out
    numbered = materialize(numbered_blocks(crowded, keys, order), "blocks")
    return out.unionByName(hot(numbered).drop("__no", "__blk"))


def last_known(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the newest value that is not null among the key's earlier rows."""

    def hot(rows: DataFrame) -> DataFrame:
        known = rows.withColumn("__at", F.when(value.isNotNull(), F.struct("__no", value.alias("v"))))
        return max_before(known, keys, "__at", "__seen").withColumn(name, F.col("__seen.v")).drop("__at", "__seen")

    return _by_key(df, keys, order, lambda rows, w: rows.withColumn(name, F.last(value, ignorenulls=True).over(w)), hot)


def largest_before(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the largest value among the key's earlier rows, null for the first."""

    def hot(rows: DataFrame) -> DataFrame:
        return max_before(rows.withColumn("__v", value), keys, "__v", name).drop("__v")

    return _by_key(df, keys, order, lambda rows, w: rows.withColumn(name, F.max(value).over(w)), hot)


def sum_before(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of a value over the key's earlier rows, 0 for the first."""

    def hot(rows: DataFrame) -> DataFrame:
        return _before(rows.withColumn("__v", value), keys, "__v", name, F.sum).withColumn(name, F.coalesce(name, F.lit(0))).drop("__v")

    return _by_key(df, keys, order, lambda rows, w: rows.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0))), hot)


def running_flags(rows: DataFrame, flag: Column, name: str) -> DataFrame:
    """Running count of a flag over rows in numbered blocks."""
    rows = materialize(rows.withColumn("__flag", flag.cast("bigint")), "flags")
    sums = rows.groupBy("__blk").agg(F.sum("__flag").alias("__s"))
    # one row per block
    before = Window.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("__blk", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__blk").orderBy("__no").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__in", F.sum("__flag").over(inside)).join(base, "__blk").withColumn(name, F.col("__in") + F.col("__base")).drop("__in", "__base", "__flag")


def split_transactions(df: DataFrame, keys: list[str], limit: int = 256) -> DataFrame:
    """Adds ``part``: the piece of at most ``limit`` rows of a split transaction."""
    placed = place_in_key(df, TXN, [op_order(), *[F.col(k) for k in keys]], "__place")
    return placed.withColumn("part", F.floor(F.col("__place") / F.lit(limit))).drop("__place")


def merge_ddl(dml: DataFrame, ddl: DataFrame, resolved: DataFrame) -> DataFrame:
    """One stream of ``ts, kind, ref``: at one ts changes come before the schema
    change and that before the watermark."""
    tag = lambda d, kind, code: d.select("ts", F.lit(code).alias("kind_no"), F.lit(kind).alias("kind"), F.col("ref").cast("string").alias("ref"))
    return tag(dml, "dml", 0).unionByName(tag(ddl, "ddl", 1)).unionByName(tag(resolved, "resolved", 2))


def bounded_scan(df: DataFrame, start_ts: int, end_ts: int, byte_limit: int, size: Column) -> DataFrame:
    """Rows of (start_ts, end_ts] up to the first transaction boundary at or
    after ``byte_limit`` bytes, whole commit timestamps only."""
    rows = df.where((F.col("commit_ts") > start_ts) & (F.col("commit_ts") <= end_ts)).withColumn("bytes", size)
    per_ts = rows.groupBy("commit_ts").agg(F.sum("bytes").alias("ts_bytes"))
    cut = scan_cut(per_ts, byte_limit)
    # one row
    return rows.join(F.broadcast(cut), F.col("commit_ts") <= F.col("cut_ts")).drop("cut_ts")


def scan_cut(per_ts: DataFrame, byte_limit: int) -> DataFrame:
    """The last commit_ts to send: the first whose running size reaches the limit.
    Sizes are first added up per bucket of about a day, then only the bucket in
    which the limit falls is looked at row by row."""
    bucket = F.floor(F.shiftright("commit_ts", 18) / F.lit(86_400_000))
    per = per_ts.withColumn("b", bucket)
    w = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = per.groupBy("b").agg(F.sum("ts_bytes").alias("bs")).withColumn("before", F.coalesce(F.sum("bs").over(w), F.lit(0)))
    sums = sums.where((F.col("before") < byte_limit) & ((F.col("before") + F.col("bs")) >= byte_limit))
    inside = Window.partitionBy("b").orderBy("commit_ts")
    at = per.join(F.broadcast(sums), "b").withColumn("running", F.sum("ts_bytes").over(inside) + F.col("before"))
    reached = at.where(F.col("running") >= byte_limit).agg(F.min("commit_ts").alias("cut"))
    last = per_ts.agg(F.max("commit_ts").alias("last"))
    return reached.crossJoin(last).select(F.coalesce("cut", "last").alias("cut_ts"))


def schema_batches(df: DataFrame, version: str) -> DataFrame:
    """Adds ``batch``: changes whenever the schema version of a table does."""
    new = F.col("is_first") | ~F.col(f"prev_{version}").eqNullSafe(F.col(version))
    first, *hot = runs(df, ["table_id"], [F.col(c) for c in ("commit_ts", "start_ts", "ref")], [version], new)
    out = first.withColumnRenamed("__run", "batch")
    for h in hot:
        out = out.unionByName(_minus_first(h, ["table_id"], "__run", "batch").drop("__run"))
    return out.withColumn("batch", F.col("batch") + 1).drop("is_first", f"prev_{version}")
