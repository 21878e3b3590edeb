"""Hybrid timestamps: 46 bits of physical milliseconds above 18 logical bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOGICAL_BITS = 18


def physical_ms(ts: Column) -> Column:
    return F.shiftright(ts, LOGICAL_BITS)


def logical(ts: Column) -> Column:
    return ts.bitwiseAND((1 << LOGICAL_BITS) - 1)


def compose(ms: Column, logical_part: Column | int = 0) -> Column:
    part = F.lit(logical_part) if isinstance(logical_part, int) else logical_part
    return F.shiftleft(ms.cast("bigint"), LOGICAL_BITS) + part
