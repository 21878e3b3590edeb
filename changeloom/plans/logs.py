"""Change logs derived from the star-schema tables, as portable SQL.

The text runs in Spark and in any engine with the same few functions; ``ms``
stands for the milliseconds of a timestamp and ``{table}`` for a source.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_PARTS = {
    # insert always, update a day later for every third key, delete two days later for every seventh
    "base": "SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, CAST(round(o_totalprice * 100) AS BIGINT) AS p, MS(o_orderdate) AS ms FROM {orders}",
    "orders_log": """SELECT k, 'I' AS op, ms * 262144 AS commit_ts, ms * 262144 - 262144 AS start_ts, CAST(NULL AS BIGINT) AS pre_p, p AS post_p, c, s FROM base
        UNION ALL SELECT k, 'U', (ms + 86400000) * 262144, (ms + 86400000) * 262144 - 262144, p, p + 1000, c, s FROM base WHERE k % 3 = 0
        UNION ALL SELECT k, 'D', (ms + 172800000) * 262144, (ms + 172800000) * 262144 - 262144, CASE WHEN k % 3 = 0 THEN p + 1000 ELSE p END, NULL, c, s FROM base WHERE k % 7 = 0""",
    "lines": "SELECT l_orderkey AS ok, l_linenumber AS ln, l_suppkey AS supp, CAST(round(l_quantity) AS BIGINT) AS qty, CAST(round(l_extendedprice * 100) AS BIGINT) AS price, l_returnflag AS rf, MS(l_shipdate) AS ms FROM {lineitem}",
    "ev": "SELECT event_id, user_id AS k, MS(ts) AS ms, CAST(round(value * 100) AS BIGINT) AS v, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM {events}",
    # every user's events as insert, update, update, delete and again
    "history_log": """SELECT event_id, k, n, CASE n % 4 WHEN 1 THEN 'I' WHEN 0 THEN 'D' ELSE 'U' END AS op, ms * 262144 + n AS commit_ts, ms * 262144 AS start_ts,
        CASE WHEN n % 4 <> 1 THEN lag(v) OVER (PARTITION BY k ORDER BY n) END AS pre_v, CASE WHEN n % 4 <> 0 THEN v END AS post_v, event_type FROM ev""",
    "prewrites": """SELECT k, ms * 262144 AS start_ts, 1 AS generation, 1 AS arrival, CAST(p AS BIGINT) AS value FROM base
        UNION ALL SELECT k, ms * 262144, 2, 2, p + 5 FROM base WHERE k % 4 = 0
        UNION ALL SELECT k, ms * 262144, 3, 3, CAST(NULL AS BIGINT) FROM base WHERE k % 9 = 0""",
    "commits": "SELECT k, ms * 262144 AS start_ts, (ms + 1000) * 262144 AS commit_ts FROM base WHERE k % 5 <> 0",
    "rollbacks": "SELECT k, ms * 262144 AS start_ts FROM base WHERE k % 10 = 0",
    "softdelete_log": """SELECT event_id, k, n, op, commit_ts, start_ts, CASE WHEN op <> 'I' AND n % 3 = 0 THEN start_ts - 5 END AS pre_deleted, CASE WHEN op <> 'D' AND n % 5 = 0 THEN start_ts END AS post_deleted,
        CASE WHEN n % 6 = 1 THEN start_ts - 100 END AS origin_ts, pre_v, post_v FROM history_log""",
    "pair_left": "SELECT c_custkey AS k, c_name AS name, CAST(round(c_acctbal * 100) AS BIGINT) AS bal, c_mktsegment AS seg, c_nationkey AS nat FROM {customer}",
    "pair_right": """SELECT k, name, CASE WHEN k % 11 = 0 THEN bal + 1 ELSE bal END AS bal, CASE WHEN k % 22 = 0 THEN CAST(NULL AS VARCHAR(10)) ELSE seg END AS seg, nat FROM pair_left WHERE k % 13 <> 0
        UNION ALL SELECT k + 100000000, name, bal, seg, nat FROM pair_left WHERE k % 17 = 0""",
    # money moves between two customers of one order in one transaction
    "bank_log": """SELECT k AS txn, c AS acct, (ms + k) * 262144 AS commit_ts, -(p % 1000) AS delta FROM base
        UNION ALL SELECT k, c + 1, (ms + k) * 262144, p % 1000 FROM base""",
    "regions": """SELECT l_suppkey AS region_id, l_suppkey * 10 AS lo, l_suppkey * 10 + 10 AS hi, MS(l_shipdate) * 262144 AS resolved_ts, l_orderkey % 8 AS node FROM {lineitem}""",
    "spans": "SELECT l_suppkey AS tbl, l_orderkey AS id, l_partkey * 10 AS lo, l_partkey * 10 + 5 + l_linenumber * 3 AS hi, MS(l_shipdate) * 262144 AS ts FROM {lineitem}",
    # schema changes: each table is created, changed, sometimes renamed or truncated, and every fourth one dropped at its end
    "ddl_raw": """SELECT p_partkey % 40 AS table_id, p_partkey * 262144 AS finished_ts, p_partkey AS job, p_size,
        row_number() OVER (PARTITION BY p_partkey % 40 ORDER BY p_partkey) AS n, row_number() OVER (PARTITION BY p_partkey % 40 ORDER BY p_partkey DESC) AS back FROM {part}""",
    "ddl_log": """SELECT table_id, finished_ts, job, n, CASE WHEN n = 1 THEN 'create table' WHEN back = 1 AND table_id % 4 = 0 THEN 'drop table' WHEN p_size % 6 = 0 THEN 'drop column'
        WHEN p_size % 6 = 1 THEN 'rename table' WHEN p_size % 6 = 2 THEN 'truncate table' WHEN p_size % 6 = 3 THEN 'modify column' ELSE 'add column' END AS kind FROM ddl_raw""",
    # jobs with physical ids: every third table is partitioned and its partitions lo..hi move with the changes of partitions
    "ddl_kinds": """SELECT table_id, finished_ts, job, n, p_size, CASE WHEN n = 1 THEN 'create table' WHEN back = 1 AND table_id % 4 = 0 THEN 'drop table' WHEN n = 3 AND table_id % 10 = 1 THEN 'modify schema charset'
        WHEN n = 4 AND table_id = 12 THEN 'create view' WHEN n = 2 AND table_id % 9 = 5 THEN 'lock table' WHEN table_id % 3 = 0 AND p_size % 6 = 0 THEN 'add partition' WHEN table_id % 3 = 0 AND p_size % 6 = 1 THEN 'truncate partition'
        WHEN table_id % 3 = 0 AND p_size % 6 = 2 THEN 'reorganize partition' WHEN table_id % 3 = 0 AND p_size % 6 = 3 THEN 'exchange partition' WHEN p_size % 6 = 0 THEN 'truncate table' WHEN p_size % 6 = 1 THEN 'drop column'
        WHEN p_size % 6 = 2 THEN 'modify column' WHEN p_size % 6 = 3 THEN 'add index' WHEN p_size % 6 = 4 THEN 'rename table' ELSE 'add column' END AS kind FROM ddl_raw""",
    "ddl_ids": """SELECT *, CASE WHEN table_id % 3 = 0 THEN 1 + sum(CASE WHEN kind IN ('truncate partition', 'exchange partition', 'reorganize partition') THEN 1 ELSE 0 END) OVER w ELSE sum(CASE WHEN kind = 'truncate table' THEN 1 ELSE 0 END) OVER w END AS lo,
        CASE WHEN table_id % 3 = 0 THEN 4 + sum(CASE WHEN kind IN ('add partition', 'reorganize partition') THEN 2 WHEN kind IN ('truncate partition', 'exchange partition') THEN 1 ELSE 0 END) OVER w ELSE sum(CASE WHEN kind = 'truncate table' THEN 1 ELSE 0 END) OVER w END AS hi,
        sum(CASE WHEN kind = 'rename table' THEN 1 ELSE 0 END) OVER w AS renames FROM ddl_kinds WINDOW w AS (PARTITION BY table_id ORDER BY n ROWS UNBOUNDED PRECEDING)""",
    "ddl_jobs": """SELECT job, finished_ts, job AS schema_version, kind, table_id % 5 AS schema_id, table_id, CASE WHEN kind <> 'drop table' THEN SEQ(table_id * 100000 + lo, table_id * 100000 + hi) END AS ids, 't' || CAST(table_id AS VARCHAR(10)) || '_' || CAST(renames AS VARCHAR(10)) AS name, renames FROM ddl_ids""",
    "ddl_dml": "SELECT event_id, user_id % 40 AS table_id, (event_id % 2500) * 262144 + 7 AS commit_ts FROM {events}",
}


def _needed(name: str, seen: list[str]) -> list[str]:
    for part in _PARTS:
        if part != name and part not in seen and re.search(rf"\bFROM {part}\b|\bJOIN {part}\b", _PARTS[name]):
            _needed(part, seen)
    if name not in seen:
        seen.append(name)
    return seen


def ctes(*names: str) -> str:
    """``WITH`` parts of the named logs for the SQL twin of a query."""
    order: list[str] = []
    for n in names:
        _needed(n, order)
    text = ",\n".join(f"{n} AS ({_PARTS[n]})" for n in order)
    text = re.sub(r"\bSEQ\((.+?), (.+?)\) END", r"CAST(generate_series(CAST(\1 AS BIGINT), CAST(\2 AS BIGINT)) AS BIGINT[]) END", text)
    return re.sub(r"\bMS\((\w+)\)", r"(epoch_us(\1) // 1000)", re.sub(r"\{(\w+)\}", r"\1", text))


def log(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The log as a DataFrame over the tables in ``d``."""
    text = ",\n".join(f"{n} AS ({_PARTS[n]})" for n in _needed(name, []))
    text = re.sub(r"\bSEQ\((.+?), (.+?)\) END", r"sequence(CAST(\1 AS BIGINT), CAST(\2 AS BIGINT)) END", text)
    text = re.sub(r"\bMS\((\w+)\)", r"unix_millis(CAST(\1 AS TIMESTAMP))", text)
    text = re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{d}/{m[1]}.parquet`", text)
    return spark.sql(f"WITH {text} SELECT * FROM {name}")
