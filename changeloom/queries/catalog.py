"""All registered queries of the core."""

from __future__ import annotations

from changeloom.queries import codecs, problems, progress, rules, streams, transactions

_MODULES = [problems, transactions, rules, codecs, progress, streams]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
