"""Rules as column expressions: table filters, event filters, row predicates,
row policies, routing and column selection. Rules are compiled on the driver to
one boolean or string expression, so they run inside the scan's own stage.
"""

from __future__ import annotations

import fnmatch
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Schemas of the database system itself, fixed values.
SYSTEM_SCHEMAS = ["information_schema", "mysql", "performance_schema", "sys", "metrics_schema", "inspection_schema"]


def _glob_regex(glob: str) -> str:
    """Anchored regular expression of a glob with ``*``, ``?`` and ``[...]``."""
    out = fnmatch.translate(glob)
    return "^(?:" + re.sub(r"^\(\?s:|\)\\[zZ]$", "", out) + ")$"


def _split(rule: str) -> tuple[bool, str, str]:
    negative = rule.startswith("!")
    schema, _, table = rule.removeprefix("!").partition(".")
    return negative, schema, table or "*"


def _like(col: Column, glob: str, case_sensitive: bool) -> Column:
    if glob == "*":
        return F.lit(True)
    if not case_sensitive:
        col, glob = F.lower(col), glob.lower()
    if not any(c in glob for c in "*?["):
        return col == glob
    return col.rlike(_glob_regex(glob))


def table_filter(schema: Column, table: Column, rules: list[str], case_sensitive: bool = False) -> Column:
    """The last rule that matches decides; ``!`` makes it exclude; nothing
    matching means excluded."""
    keep = F.lit(False)
    for rule in rules:
        negative, s, t = _split(rule)
        hit = _like(schema, s, case_sensitive) & _like(table, t, case_sensitive)
        keep = F.when(hit, F.lit(not negative)).otherwise(keep)
    return keep


def not_system(schema: Column) -> Column:
    return ~F.lower(schema).isin(SYSTEM_SCHEMAS)


@dataclass(frozen=True)
class EventRule:
    matcher: list[str]
    ignore_event: list[str] = field(default_factory=list)
    ignore_sql: list[str] = field(default_factory=list)


_DML = {"I": "insert", "U": "update", "D": "delete"}


def keep_event(schema: Column, table: Column, op: Column, rules: list[EventRule]) -> Column:
    """False where a matching rule ignores the kind of change."""
    drop = F.lit(False)
    for r in rules:
        names = {e.lower() for e in r.ignore_event}
        if "none" in names and len(names) == 1:
            continue
        ops = [k for k, v in _DML.items() if v in names or names & {"all dml", "all"}]
        drop = drop | (table_filter(schema, table, r.matcher) & op.isin(ops)) if ops else drop
    return ~F.coalesce(drop, F.lit(False))


def keep_ddl(schema: Column, table: Column, kind: Column, query: Column, rules: list[EventRule]) -> Column:
    """A schema change is ignored by its type, by a generic ``alter table`` or by
    a pattern on its text."""
    drop = F.lit(False)
    for r in rules:
        names = [e.lower() for e in r.ignore_event]
        hit = F.lower(kind).isin(names)
        if "all ddl" in names or "all" in names:
            hit = F.lit(True)
        if "alter table" in names:
            hit = hit | F.lower(query).rlike(r"^\s*alter\s+table\b")
        for pattern in r.ignore_sql:
            hit = hit | query.rlike(pattern)
        drop = drop | (table_filter(schema, table, r.matcher) & hit)
    return ~F.coalesce(drop, F.lit(False))


def bind(expression: str, image: str, columns: list[str]) -> Column:
    """A row predicate with its column names bound to an image's columns."""
    names = "|".join(sorted(map(re.escape, columns), key=len, reverse=True))
    parts = re.split(r"('(?:[^'\\]|\\.)*')", expression)
    parts[::2] = [re.sub(rf"(?<![\w.])`?({names})`?(?![\w(])", lambda m: f"{image}_{m[1]}", p) for p in parts[::2]]
    return F.expr("".join(parts))


def keep_row(op: Column, columns: list[str], insert: str | None = None, update_old: str | None = None, update_new: str | None = None, delete: str | None = None) -> Column:
    """False where a predicate is true for the row; null keeps the row."""
    true = lambda e, image: F.coalesce(bind(e, image, columns), F.lit(False)) if e else F.lit(False)
    drop = (
        F.when(op == "I", true(insert, "post"))
        .when(op == "U", true(update_old, "pre") | true(update_new, "post"))
        .when(op == "D", true(delete, "pre"))
    )
    return ~F.coalesce(drop, F.lit(False))


def soft_delete_policy(op: Column, pre_deleted: Column, post_deleted: Column, mode: str) -> Column:
    """The operation that goes on, null for none. ``normal``: as it is;
    ``active``: inserts and updates only; ``soft``: no deletes, and an update
    that sets the deletion time becomes a delete of the old image."""
    if mode == "normal":
        return op
    if mode == "active":
        return F.when(op != "D", op)
    return F.when(op == "D", F.lit(None)).when((op == "U") & pre_deleted.isNull() & post_deleted.isNotNull(), "D").otherwise(op)


def route_table(schema: Column, table: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Target schema and table: the first rule ``(matcher, schema template,
    table template)`` that matches; an empty template keeps the source."""
    ts, tt = schema, table
    fill = lambda t, own: own if not t else F.replace(F.replace(F.lit(t), F.lit("{schema}"), schema), F.lit("{table}"), table)
    for matcher, s, t in reversed(rules):
        hit = table_filter(schema, table, [matcher])
        ts, tt = F.when(hit, fill(s, schema)).otherwise(ts), F.when(hit, fill(t, table)).otherwise(tt)
    return ts, tt


#: Limits of message topic names, fixed values.
TOPIC_MAX = 249
TOPIC_BAD = r"[^a-zA-Z0-9\._\-]"


def topic(schema: Column, table: Column, template: str) -> Column:
    """Topic of a table: the names, with forbidden characters as ``_``, take the
    places in the template; at most 249 characters; the two reserved names are
    replaced. Case is kept."""
    clean = lambda c: F.regexp_replace(c, TOPIC_BAD, "_")
    name = F.replace(F.replace(F.lit(template), F.lit("{schema}"), clean(schema)), F.lit("{table}"), clean(table))
    name = F.substring(name, 1, TOPIC_MAX)
    return F.when(name == ".", "_").when(name == "..", "__").otherwise(name)


def topic_valid(template: str, needs_both: bool = False) -> bool:
    """At most one ``{schema}`` and after it one ``{table}``; what stands before,
    between and after them holds no forbidden character."""
    rest, places = template, 0
    for place in ("{schema}", "{table}"):
        before, found, after = rest.partition(place)
        if found:
            if re.search(TOPIC_BAD, before):
                return False
            rest, places = after, places + 1
    return not re.search(TOPIC_BAD, rest) and (places == 2 or not needs_both)


def dispatch_topic(schema: Column, table: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Topic by the first matching rule, else the default topic."""
    out = F.lit(default)
    for matcher, template in reversed(rules):
        out = F.when(table_filter(schema, table, [matcher]), topic(schema, table, template)).otherwise(out)
    return out


def to_partitions(df: DataFrame, parts: Column, every: Column) -> DataFrame:
    """Adds ``part``: a schema change or checkpoint goes to each of its topic's
    ``parts`` partitions where ``every`` is true, else to partition 0."""
    return df.withColumn("part", F.explode(F.sequence(F.lit(0), F.when(every, parts.cast("int") - 1).otherwise(0))))


def select_columns(columns: list[str], rules: list[str], keys: list[list[str]], used: list[str] | None = None) -> list[str]:
    """Columns kept by globs, the last match deciding. One of ``keys`` (the
    primary key or a unique key) must stay whole, and every column that a
    partition rule uses (``used``) must stay too."""
    kept = []
    for c in columns:
        keep = False
        for r in rules:
            if fnmatch.fnmatch(c.lower(), r.removeprefix("!").lower()):
                keep = not r.startswith("!")
        if keep:
            kept.append(c)
    if keys and not any(key and set(key) <= set(kept) for key in keys):
        raise ValueError(f"the selector keeps no key whole: {keys}")
    if not set(used or ()) <= set(kept):
        raise ValueError(f"the selector drops columns of the partition rule: {sorted(set(used) - set(kept))}")
    return kept


def key_hash(schema: Column, table: Column, parts: list[tuple[str, Column]]) -> Column:
    """Partition hash: CRC32 of schema and table, XOR the CRC32 of each name with
    its value; null values are left out. The order of the parts has no effect."""
    crc = lambda *x: F.crc32(F.encode(F.concat(*x), "UTF-8"))
    h = crc(schema, table)
    for name, value in parts:
        h = h.bitwiseXOR(F.coalesce(crc(F.lit(name), value.cast("string")), F.lit(0)))
    return h
