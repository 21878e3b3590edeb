"""Registration of a query together with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None):
        def add(f: Callable) -> Callable:
            key = name or f.__name__
            self.queries[key] = f
            if sql:
                self.sql[key] = sql
            return f

        return add


def hex_bytes_sql(hexed: str) -> str:
    """List of the byte values of a hexadecimal text, in SQL."""
    digit = lambda at: f"(strpos('0123456789ABCDEF', substr({hexed}, CAST({at} AS BIGINT), 1)) - 1)"
    return f"list_transform(range(0, length({hexed}) // 2), lambda i: CAST({digit('2 * i + 1')} * 16 + {digit('2 * i + 2')} AS BIGINT))"


def text_bytes_sql(text: str) -> str:
    return hex_bytes_sql(f"hex(encode({text}))")


def crc32_sql(values: str) -> str:
    """CRC32 of a list of byte values, bit by bit, in SQL."""
    bit = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    step = f"lambda c, v: list_reduce(list_prepend(xor(c, v), range(0, 8)), {bit})"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {values}), {step}))"
