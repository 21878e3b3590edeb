"""Splitting, compacting and applying changes per key.

Row order inside a key is (commit_ts, seq). ``fold_runs`` has the rules of the
unsafe mode: rows are cut into runs, each ending at its first delete, and a run
leaves one row (see the table in its docstring).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeloom.operators.ordering import _minus_first, op_order, place_in_key, runs, with_previous
from changeloom.session import materialize


def split_updates(df: DataFrame, changed: Column, pre: list[str], post: list[str]) -> DataFrame:
    """An update that changes an index column becomes a delete now and an insert
    deferred to the end of its transaction (``deferred`` = 1)."""
    gone = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in post]
    none = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in pre]
    rest = [c for c in df.columns if c not in (*pre, *post, "op")]
    row = lambda op, deferred, a, b: F.struct(F.lit(op).alias("op") if isinstance(op, str) else op.alias("op"), F.lit(deferred).alias("deferred"), *a, *b)
    keep_pre, keep_post = [F.col(c) for c in pre], [F.col(c) for c in post]
    out = F.when((F.col("op") == "U") & changed, F.array(row("D", 0, keep_pre, gone), row("I", 1, none, keep_post))).otherwise(
        F.array(row(F.col("op"), 0, keep_pre, keep_post)))
    return df.select(*rest, F.explode(out).alias("__row")).select(*rest, "__row.*")


def fold_runs(df: DataFrame, keys: list[str], seq: list[str], pre: str, post: str) -> DataFrame:
    """Compact to one row per run.

    lone D: itself. I, U*: insert of the last image. I, U*, D: the delete.
    U+: update with the last row's images. U+, D: delete with the last update's
    old image and the delete's commit_ts. ``bad`` marks I or U followed by I.
    ``run`` counts the runs of a key from 0.

    A run starts at the first row of a key and after each of its deletes. Runs of
    a hot key are counted over blocks of rows, so neither it nor a long run makes
    a long task.
    """
    starts = F.col("is_first") | F.coalesce(F.col("prev_op") == "D", F.lit(False))
    first, *hot = runs(df, keys, [F.col(c) for c in seq], ["op"], starts)
    out = _fold(first, keys, seq, pre, post).withColumnRenamed("__run", "run")
    for h in hot:
        folded = materialize(_fold(h, keys, seq, pre, post), "folded")
        out = out.unionByName(_minus_first(folded, keys, "__run", "run").drop("__run"))
    return out.select(*keys, "run", "op", *seq, pre, post, "bad")


def _fold(rows: DataFrame, keys: list[str], seq: list[str], pre: str, post: str) -> DataFrame:
    rows = rows.withColumn("__bad", (F.col("op") == "I") & F.coalesce(F.col("prev_op").isin("I", "U"), F.lit(False)))
    at = F.struct(*seq)
    g = rows.groupBy(*keys, "__run").agg(
        F.min_by("op", at).alias("f"), F.max_by("op", at).alias("l"), F.max_by(F.struct(*seq, pre, post), at).alias("last"),
        F.max_by(F.when(F.col("op") == "U", F.col(pre)), F.when(F.col("op") == "U", at)).alias("last_u"), F.bool_or("__bad").alias("bad"),
    )
    op = F.when(F.col("l") == "D", "D").when(F.col("f") == "I", "I").otherwise("U")
    pre_image = (
        F.when((F.col("l") == "D") & (F.col("f") == "U"), F.col("last_u"))
        .when(op == "I", F.lit(None).cast(rows.schema[pre].dataType)).otherwise(F.col(f"last.{pre}"))
    )
    return g.select(*keys, "__run", op.alias("op"), *[F.col(f"last.{s}").alias(s) for s in seq], pre_image.alias(pre), F.col(f"last.{post}").alias(post), "bad")


def keep_last(df: DataFrame, keys: list[str], seq: list[str], pre: str, post: str) -> DataFrame:
    """Safe mode: an update is a delete and an insert; only the last row per key
    stays. Combines on the map side, so a hot key does no harm."""
    half = F.when(
        F.col("op") == "U",
        F.array(F.struct(F.lit("D").alias("op"), F.lit(0).alias("half"), F.col(pre).alias("image")), F.struct(F.lit("I").alias("op"), F.lit(1).alias("half"), F.col(post).alias("image"))),
    ).otherwise(F.array(F.struct(F.col("op").alias("op"), F.lit(0).alias("half"), F.coalesce(post, pre).alias("image"))))
    rows = df.select(*keys, *seq, F.explode(half).alias("h")).select(*keys, *seq, "h.*")
    last = rows.groupBy(*keys).agg(F.max(F.struct(*seq, "half", "op", "image")).alias("x"))
    return last.select(*keys, *[F.col(f"x.{s}").alias(s) for s in seq], F.col("x.op").alias("op"), F.col("x.image").alias("image"))


def apply_log(df: DataFrame, keys: list[str], seq: list[Column], values: list[str], at_ts: int | None = None) -> DataFrame:
    """The table after all changes (up to ``at_ts``): the newest change per key,
    without deletes."""
    rows = df if at_ts is None else df.where(F.col("commit_ts") <= at_ts)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct("op", *values), F.struct(*seq)).alias("x"))
    return last.where("x.op <> 'D'").select(*keys, *[F.col(f"x.{v}").alias(v) for v in values])


def emit_order(df: DataFrame, max_rows: int, keys: list[str]) -> DataFrame:
    """Deletes, then updates, then inserts, in chunks of at most ``max_rows``."""
    placed = place_in_key(df, ["op", *keys[:-1]], [F.col(keys[-1])], "__place")
    return placed.withColumn("op_no", op_order()).withColumn("chunk", F.floor(F.col("__place") / F.lit(max_rows))).drop("__place")


def last_writer_wins(target: DataFrame, source: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Upsert where the target's ``coalesce(origin_ts, commit_ts)`` does not
    exceed the source's commit_ts, which becomes the new origin_ts."""
    t = target.select(*keys, F.col(value).alias("t_value"), F.coalesce("origin_ts", "commit_ts").alias("t_ts"), F.col("origin_ts").alias("t_origin"), F.lit(True).alias("has_t"))
    s = source.select(*keys, F.col(value).alias("s_value"), F.col("commit_ts").alias("s_ts"))
    j = t.join(s, keys, "full_outer")
    wins = F.col("s_ts").isNotNull() & (F.col("has_t").isNull() | (F.col("t_ts") <= F.col("s_ts")))
    return j.select(*keys, F.when(wins, F.col("s_value")).otherwise(F.col("t_value")).alias(value), F.when(wins, F.col("s_ts")).otherwise(F.col("t_origin")).alias("origin_ts"))


def conflict_edges(df: DataFrame, indexes: dict[str, list[str]], table_key: Column) -> DataFrame:
    """Dependencies between transactions: ``txn, depends_on``, through the latest
    earlier transaction with an equal unique key. An index with a null value is
    ignored; a row without any usable index conflicts on its table."""
    keys = [
        F.when(F.forall(F.array(*[F.col(c).isNotNull() for c in cols]), lambda x: x), F.concat_ws("|", F.lit(name), *[F.col(c).cast("string") for c in cols]))
        for name, cols in indexes.items()
    ]
    usable = F.array_compact(F.array(*keys))
    all_keys = F.when(F.size(usable) > 0, usable).otherwise(F.array(table_key))
    rows = df.select("txn", F.explode(all_keys).alias("key"))
    # a key that a transaction has several times follows itself there, which is no dependency
    before = with_previous(rows, ["key"], [F.col("txn")], ["txn"]).where("prev_txn <> txn")
    return before.select("txn", F.col("prev_txn").alias("depends_on")).distinct()


def diff_rows(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Full outer compare: status and the operation that repairs the right side."""
    l = left.select(*keys, F.struct(*values).alias("a"))
    r = right.select(*keys, F.struct(*values).alias("b"))
    j = l.join(r, keys, "full_outer")
    status = F.when(F.col("b").isNull(), "left_only").when(F.col("a").isNull(), "right_only").when(F.col("a").eqNullSafe(F.col("b")), "equal").otherwise("different")
    fix = F.when(status == "left_only", "insert").when(status == "right_only", "delete").when(status == "different", "replace")
    return j.select(*keys, status.alias("status"), fix.alias("fix"))


def compare_structure(spark: SparkSession, left: StructType, right: StructType, ignore: list[str] | None = None) -> DataFrame:
    """``column, left, right, equal``: the columns of two tables and their types,
    by name without case; the order of columns does not count."""
    skip = {c.lower() for c in ignore or ()}
    a, b = ({f.name.lower(): f.dataType.simpleString() for f in t.fields} for t in (left, right))
    rows = [(c, a.get(c), b.get(c), a.get(c) == b.get(c)) for c in sorted(a.keys() | b.keys()) if c not in skip]
    return spark.createDataFrame(rows, "column string, left string, right string, equal boolean")
