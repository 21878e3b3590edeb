"""Schema changes driven by one table of kinds: whose history a change enters,
which physical tables it removes and creates, what it blocks, and how filters,
repeats and renames decide on it.

A job has ``job, finished_ts, schema_version, kind, schema_id, table_id, ids``:
``ids`` are the physical ids (partitions, or the table's own) after the job,
null if the table is gone. State per table is a window over its jobs; in it ids
are spans of consecutive numbers, as a table may have very many.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.operators.ordering import largest_before, place_in_key, with_previous
from changeloom.session import materialize

#: Id of the history that starts new tables.
TRIGGER = -1
#: Jobs of one table that the stays of its ids meet at once.
BLOCK_JOBS = 1024
_SPANS = "array<struct<lo: bigint, hi: bigint>>"


@dataclass(frozen=True)
class Kind:
    """``targets``: histories a change enters besides: trigger, before and after
    (physical ids of the table), schema (every table of the schema), all (every
    table). ``scope``: single, multi, schema. ``versions``: whether the table's
    rows are decoded by a new version from here on."""

    targets: tuple[str, ...]
    scope: str = "single"
    blocks: bool = False
    versions: bool = True


def _kinds(names: str, *targets: str, **rest) -> dict[str, Kind]:
    return {n.strip(): Kind(targets, **rest) for n in names.split(",")}


#: The kinds of schema changes and their effect, fixed values.
KINDS: dict[str, Kind] = {
    **_kinds("create schema", "trigger", scope="schema", versions=False),
    **_kinds("drop schema", "trigger", "schema", scope="schema", blocks=True, versions=False),
    **_kinds("modify schema charset", "trigger", "schema", scope="schema", versions=False),
    **_kinds("create table, recover table", "trigger", "after"),
    **_kinds("drop table", "trigger", "before", blocks=True),
    **_kinds("rename table", "trigger", "before", blocks=True),
    **_kinds("truncate table", "trigger", "before", "after", blocks=True),
    **_kinds("rename tables, create tables", "trigger", "after", scope="multi", blocks=True),
    **_kinds("create view", "trigger", "all", scope="schema", blocks=True, versions=False),
    **_kinds("drop view", "trigger", scope="schema", versions=False),
    **_kinds("add column, drop column, modify column, set default value, add index, drop index, rename index, alter index visibility", "before"),
    **_kinds("add primary key, drop primary key, add foreign key, drop foreign key, modify table comment, modify table charset", "before"),
    **_kinds("rebase auto id, shard row id, add fulltext index, create hybrid index, multi schema change, alter ttl, remove ttl", "before"),
    **_kinds("add partition", "trigger", "after", blocks=True),
    **_kinds("drop partition", "trigger", "before", blocks=True),
    **_kinds("truncate partition, reorganize partition, alter partitioning, remove partitioning", "trigger", "before", "after", blocks=True),
    **_kinds("exchange partition", "trigger", "gone", "table", blocks=True),
}


def _in(kind: Column, test) -> Column:
    return kind.isin([k for k, v in KINDS.items() if test(v)])


def classify(kind: Column) -> tuple[Column, Column, Column]:
    """(scope, whether it blocks, whether it enters the trigger's history); null
    for an unknown kind."""
    scope = F.lit(None).cast("string")
    for s in ("single", "multi", "schema"):
        scope = F.when(_in(kind, lambda v, s=s: v.scope == s), s).otherwise(scope)
    known = kind.isin(list(KINDS))
    return scope, F.when(known, _in(kind, lambda v: v.blocks)), F.when(known, _in(kind, lambda v: "trigger" in v.targets))


def _none() -> Column:
    return F.array().cast(_SPANS)


def spans(ids: Column | str) -> Column:
    """``ids`` as runs of consecutive numbers, in their order: a table of many
    partitions is a few numbers, not one per partition. Null stays null."""
    ids = (F.col(ids) if isinstance(ids, str) else ids).cast("array<bigint>")
    n, first = F.size(ids), F.get(ids, 0)
    # each element beside the one before and the one after it
    starts = F.zip_with(ids, F.concat(F.array(F.lit(None).cast("bigint")), ids), lambda x, p: F.when(~x.eqNullSafe(p + 1), x))
    ends = F.zip_with(ids, F.slice(ids, F.lit(2), F.greatest(n, F.lit(0))), lambda x, q: F.when(~q.eqNullSafe(x + 1), x))
    kept = lambda a: F.filter(a, lambda x: x.isNotNull())
    runs = F.zip_with(kept(starts), kept(ends), lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi")))
    last = first + n - 1
    return F.when(ids == F.sequence(first, last), F.array(F.struct(first.alias("lo"), last.alias("hi"))).cast(_SPANS)).otherwise(runs.cast(_SPANS))


def listed(s: Column) -> Column:
    """The ids of spans, one by one."""
    return F.flatten(F.transform(s, lambda x: F.sequence(x["lo"], x["hi"])))


def without(a: Column, b: Column) -> Column:
    """The spans of the ids in ``a`` and not in ``b``."""
    piece = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    beside = lambda x, y: F.array(piece(x["lo"], F.least(x["hi"], y["lo"] - 1)), piece(F.greatest(x["lo"], y["hi"] + 1), x["hi"]))
    cut = F.aggregate(b, a, lambda left, y: F.filter(F.flatten(F.transform(left, lambda x: beside(x, y))), lambda x: x["lo"] <= x["hi"]).cast(_SPANS))
    # lists of many spans are compared id by id
    many = spans(F.array_except(listed(a), listed(b)))
    return F.when(F.size(a) * F.size(b) <= 256, cut).otherwise(many)


def _each(rows: DataFrame, s: Column, *rest) -> DataFrame:
    """A row per id (``target``) of the spans ``s``, with the columns ``rest``."""
    some = rows.select(F.explode(s).alias("__s"), *rest)
    return some.select(F.explode(F.sequence("__s.lo", "__s.hi")).alias("target"), *[c for c in some.columns if c != "__s"])


def _slim(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("__ids", spans(F.col("ids"))).drop("ids")


def _states(slim: DataFrame, *more: str) -> DataFrame:
    rows = with_previous(slim, ["table_id"], [F.col("finished_ts"), F.col("job")], ["__ids", *more])
    return rows.withColumn("before", F.coalesce("prev___ids", _none())).withColumn("after", F.coalesce("__ids", _none())).drop("prev___ids", "__ids")


def states(jobs: DataFrame) -> DataFrame:
    """``ids`` becomes ``before``, the spans of the table's physical ids before
    each job, and ``after``; empty arrays where the table does not exist."""
    return _states(_slim(jobs)).drop("is_first")


def _effects(rows: DataFrame) -> DataFrame:
    return rows.withColumn("created", without(F.col("after"), F.col("before"))).withColumn("dropped", without(F.col("before"), F.col("after")))


def effects(jobs: DataFrame) -> DataFrame:
    """Adds the spans of ``created`` and ``dropped`` physical ids of each job to
    :func:`states`."""
    return _effects(states(jobs))


def history(jobs: DataFrame) -> DataFrame:
    """``target, finished_ts, job``: every history that a job enters, once. The
    tables of a schema (or all) are those alive when the job runs; jobs of such
    kinds are few and meet the lifetimes by schema. The histories of all other
    jobs are written out from their spans as they are returned."""
    rows = materialize(_effects(_states(_slim(jobs), "schema_id")), "effects")
    has = lambda *names: _in(F.col("kind"), lambda v: set(names) <= set(v.targets))
    # disjoint parts: what is created is not in before, what is gone not in after
    whole = F.when(has("before", "after"), F.concat("before", "created")).when(has("before"), F.col("before")).when(has("after", "gone"), F.concat("after", "dropped"))
    rows = rows.withColumn("own", whole.when(has("after"), F.col("after")).when(has("gone"), F.col("dropped")).otherwise(_none()))
    inside = lambda x: F.exists("own", lambda s: (s["lo"] <= x) & (s["hi"] >= x))
    for name, x in (("table", F.col("table_id").cast("bigint")), ("trigger", F.lit(TRIGGER).cast("bigint"))):
        new = has(name) & ~inside(x)
        rows = rows.withColumn("own", F.when(new, F.concat("own", F.array(F.struct(x.alias("lo"), x.alias("hi"))))).otherwise(F.col("own")))
    is_wide = _in(F.col("kind"), lambda v: {"schema", "all"} & set(v.targets))
    entered = rows.select("finished_ts", "job", "own", F.coalesce(is_wide, F.lit(False)).alias("wide"))
    by_job = entered.groupBy("finished_ts", "job").agg(F.flatten(F.collect_list("own")).alias("own"), F.count("*").alias("n"), F.max("wide").alias("wide"))
    by_job = by_job.withColumn("own", F.when(F.col("n") == 1, F.col("own")).otherwise(spans(F.array_distinct(listed(F.col("own"))))))
    direct = lambda of: _each(by_job.where(of), F.col("own"), "finished_ts", "job")
    wide = rows.where(is_wide).select(
        F.col("schema_id").alias("of_schema"), F.col("finished_ts").alias("at"), F.col("job").alias("by"), _in(F.col("kind"), lambda v: "all" in v.targets).alias("everything"))
    # ids are new to their schema in the job that creates them or that moves the table
    fresh = F.when(~F.col("is_first") & F.col("schema_id").eqNullSafe(F.col("prev_schema_id")), F.col("created")).otherwise(F.col("after"))
    alive = _each(rows, fresh, "schema_id", F.col("finished_ts").alias("from_ts"), "table_id")
    ends = _each(rows, F.col("dropped"), "table_id", F.col("finished_ts").alias("to_ts")).groupBy("table_id", "target").agg(F.min("to_ts").alias("to_ts"))
    lives = alive.groupBy("schema_id", "table_id", "target").agg(F.min("from_ts").alias("from_ts")).join(ends, ["table_id", "target"], "left")
    meets = (F.col("from_ts") <= F.col("at")) & (F.col("to_ts").isNull() | (F.col("to_ts") >= F.col("at")))
    in_schema = wide.where("not everything").join(lives, (F.col("of_schema") == F.col("schema_id")) & meets)
    every = wide.where("everything").withColumn("__one", F.lit(1)).join(lives.withColumn("__1", F.lit(1)), (F.col("__one") == F.col("__1")) & meets)
    spread = lambda d: d.select("target", F.col("at").alias("finished_ts"), F.col("by").alias("job"))
    return direct("not wide").unionByName(direct("wide").unionByName(spread(in_schema)).unionByName(spread(every)).distinct())


def _stays(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(stays, ends)`` of physical ids in the ranks ``r`` of their table's jobs.
    A stay ``table_id, target, r1, r2`` is an unbroken row of jobs that hold the
    id, with ``to_ts``, the next change after it, and ``earlier``, the jobs that
    held the id before; ``odd`` says that several tables hold the id. An end
    ``table_id, target, finished_ts, job, odd`` is a job that drops it."""
    rows = with_previous(rows, ["table_id"], [F.col("r")], ["after"])
    held = F.coalesce("prev_after", _none())
    mark = lambda s, **is_: _each(rows, s, "table_id", "r", "finished_ts", "job", *[F.lit(v).alias(k) for k, v in is_.items()])
    born, left = without(F.col("after"), held), without(held, F.col("after"))
    marks = mark(born, born=1, gone=0, end=0).unionByName(mark(left, born=0, gone=1, end=0)).unionByName(mark(F.col("dropped"), born=0, gone=0, end=1))
    key = ["target", "table_id", "r"]
    marks = marks.groupBy(*key).agg(F.max("finished_ts").alias("finished_ts"), F.max("job").alias("job"), *[F.max(c).alias(c) for c in ("born", "gone", "end")])
    of_id = Window.partitionBy("target")
    marks = marks.withColumn("odd", F.min(F.struct("table_id")).over(of_id) != F.max(F.struct("table_id")).over(of_id))
    w = Window.partitionBy("target", "table_id").orderBy("r")
    later = w.rowsBetween(1, Window.unboundedFollowing)
    marks = marks.withColumn("__left", F.first(F.when(F.col("gone") == 1, F.col("r")), ignorenulls=True).over(later)) \
        .withColumn("to_ts", F.first(F.when(F.col("born") + F.col("end") > 0, F.col("finished_ts")), ignorenulls=True).over(later))
    last = rows.groupBy(F.col("table_id").alias("__t")).agg(F.max("r").alias("__last"))
    marks = materialize(marks.join(last, F.col("table_id").eqNullSafe(F.col("__t"))), "marks")
    stays = marks.where("born = 1").withColumn("r1", F.col("r")).withColumn("r2", F.coalesce(F.col("__left") - 1, F.col("__last")))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    stays = stays.withColumn("earlier", F.coalesce(F.sum(F.col("r2") - F.col("r1") + 1).over(before), F.lit(0)))
    return stays.select("table_id", "target", "r1", "r2", "to_ts", "earlier", "odd"), marks.where("end = 1").select("table_id", "target", "finished_ts", "job", "odd")


def versions(jobs: DataFrame) -> DataFrame:
    """``target, from_ts, to_ts, version``: lifetimes of the versions of every
    physical table; one ends with its table's next version or when it is dropped.

    There is a row per job and id that it holds, far more than jobs. So rows are
    neither shuffled nor sorted: the stays of ids meet their table's jobs in
    blocks of :data:`BLOCK_JOBS` and are written out there. Ids that several
    tables hold are ordered row by row."""
    rows = effects(jobs).where(_in(F.col("kind"), lambda v: v.versions)).select("table_id", "finished_ts", "job", "after", "dropped")
    rows = materialize(place_in_key(rows, ["table_id"], [F.col("finished_ts"), F.col("job")], "r"), "ranked")
    stays, ends = _stays(rows)
    # a block also has the first job of the next one
    own = F.floor(F.col("r") / F.lit(BLOCK_JOBS))
    at = rows.select(F.col("table_id").alias("__t"), F.struct("r", "finished_ts", "job").alias("x"), F.explode(F.when(F.col("r") % BLOCK_JOBS == 0, F.array(own, own - 1)).otherwise(F.array(own))).alias("__b"))
    blocks = at.groupBy("__t", "__b").agg(F.array_sort(F.collect_list("x")).alias("x"))
    blocks = blocks.select("__t", "__b", F.col("x.finished_ts").alias("__ts"), F.col("x.job").alias("__jobs"))

    def written(some: DataFrame) -> DataFrame:
        cut = some.withColumn("__k", F.explode(F.sequence(F.floor(F.col("r1") / F.lit(BLOCK_JOBS)), F.floor(F.col("r2") / F.lit(BLOCK_JOBS)))))
        met = cut.join(blocks, F.col("table_id").eqNullSafe(F.col("__t")) & (F.col("__k") == F.col("__b")))
        first = F.col("__b") * BLOCK_JOBS
        return met.select("*", F.explode(F.sequence(F.greatest("r1", first), F.least("r2", first + (BLOCK_JOBS - 1)))).alias("r")).withColumn("__i", (F.col("r") - first).cast("int"))

    own_ts, next_ts = F.get("__ts", F.col("__i")), F.get("__ts", F.col("__i") + 1)
    out = written(stays.where("not odd")).select(
        "target", own_ts.alias("from_ts"), F.when(F.col("r") < F.col("r2"), next_ts).otherwise(F.col("to_ts")).alias("to_ts"), (F.col("earlier") + F.col("r") - F.col("r1") + 1).alias("version"))
    odd = stays.where("odd")
    if odd.isEmpty():
        return out
    held = written(odd).select("target", own_ts.alias("finished_ts"), F.get("__jobs", F.col("__i")).alias("job"), F.lit(False).alias("end"))
    gone = ends.where("odd").select("target", "finished_ts", "job", F.lit(True).alias("end"))
    # the change after a version: lead by way of the reversed order
    later = with_previous(held.unionByName(gone), ["target"], [-F.col("finished_ts"), -F.col("job")], ["finished_ts"])
    counted = place_in_key(later.where("not end"), ["target"], [F.col("finished_ts"), F.col("job")], "version")
    return out.unionByName(counted.select("target", F.col("finished_ts").alias("from_ts"), F.col("prev_finished_ts").alias("to_ts"), (F.col("version") + 1).alias("version")))


def skip_reason(jobs: DataFrame) -> DataFrame:
    """Adds ``reason`` for which a job is skipped, null if it is applied:
    ``unknown`` kind, ``repeated`` (its schema version is not above all before
    it), ``exists`` (a table is created that is there), ``missing`` (a table is
    dropped that is not there)."""
    slim = _slim(jobs).withColumn("__all", F.lit(0))
    seen = largest_before(slim, ["__all"], [F.col("finished_ts"), F.col("job"), F.col("schema_version")], F.col("schema_version"), "__seen")
    repeated = F.coalesce(F.col("schema_version") <= F.col("__seen"), F.lit(False))
    # the order of repeated jobs is taken once
    marked = materialize(seen.drop("__all").withColumn("__again", repeated), "seen")
    first = _states(marked.where("not __again").withColumn("__own", F.col("__ids")))
    reason = (
        F.when(~F.col("kind").isin(list(KINDS)), "unknown")
        .when((F.col("kind") == "create table") & (F.size("before") > 0), "exists")
        .when((F.col("kind") == "drop table") & (F.size("before") == 0), "missing")
    )
    again = marked.where("__again").withColumn("__own", F.col("__ids")).withColumn("reason", F.when(~F.col("kind").isin(list(KINDS)), "unknown").otherwise("repeated"))
    cols = [*[c for c in jobs.columns if c != "ids"], "__own", "reason"]
    out = first.withColumn("reason", reason).select(*cols).unionByName(again.select(*cols))
    return out.withColumn("ids", listed(F.col("__own")).cast(jobs.schema["ids"].dataType)).select(*jobs.columns, "reason")


def rename_effect(old_kept: Column, new_kept: Column, old_schema: Column, new_schema: Column, old_not_sync: Column) -> tuple[Column, Column, Column]:
    """(outcome, schema change, not sync) of a rename under a filter on both
    names. A table that was left out cannot come in by a rename; whether a rename
    is sent follows the old name."""
    outcome = F.when(old_kept & new_kept, "rename").when(old_kept, "rename and drop").when(new_kept, "error").otherwise("ignored")
    return outcome, F.when(outcome == "rename", old_schema != new_schema).otherwise(F.lit(False)), F.when(old_kept, old_not_sync).otherwise(F.lit(True))


def names_at(jobs: DataFrame, ts: int, dropped: bool = False) -> DataFrame:
    """``table_id, schema_id, name`` valid at ``ts``; with ``dropped`` those of
    tables that are gone too."""
    last = jobs.where(F.col("finished_ts") <= ts).groupBy("table_id").agg(F.max_by(F.struct("schema_id", "name", "kind"), F.struct("finished_ts", "job")).alias("x"))
    rows = last if dropped else last.where("x.kind <> 'drop table'")
    return rows.select("table_id", "x.schema_id", "x.name")


def verify_tables(columns: DataFrame, indexes: DataFrame, origin: str, deleted: str) -> DataFrame:
    """Per table ``splittable`` (a primary key and no other unique key) and
    ``active_active``: null if it can take part, else what is wrong with its
    columns ``origin`` (ts of the first writer) and ``deleted`` (soft delete).

    ``columns``: ``table_id, column, type, nullable``; ``indexes``: ``table_id,
    index, is_primary, is_unique``."""
    of = lambda name: F.max(F.when(F.col("column") == name, F.struct("type", "nullable")))
    cols = columns.groupBy("table_id").agg(of(origin).alias("origin"), of(deleted).alias("deleted"))
    keys = indexes.groupBy("table_id").agg(F.bool_or("is_primary").alias("pk"), F.bool_or(F.col("is_unique") & ~F.col("is_primary")).alias("uk"))
    wrong = (
        F.when(F.col("origin").isNull(), f"no {origin}").when(F.col("deleted").isNull(), f"no {deleted}")
        .when((F.col("deleted.type") != "timestamp(6)") | ~F.col("deleted.nullable"), f"{deleted} is no timestamp(6) null")
    )
    return cols.join(keys, "table_id", "left").select("table_id", F.coalesce(F.col("pk") & ~F.col("uk"), F.lit(False)).alias("splittable"), wrong.alias("active_active"))
