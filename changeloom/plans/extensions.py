"""Where a user's own code enters: filters, encoders and partition rules as
column expressions, and Python functions for SQL.

An extension that is a column expression stays in the JVM. A Python function is
registered as a vectorised UDF (a column to a column), a grouped aggregate (a
group to a value) or a table function (a row to rows).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.functions import PandasUDFType, pandas_udf, udtf


@runtime_checkable
class RowFilter(Protocol):
    """True for changes that go on."""

    def keep(self, changes: DataFrame) -> Column: ...


@runtime_checkable
class Encoder(Protocol):
    """The message of a change."""

    def encode(self, changes: DataFrame) -> Column: ...


@runtime_checkable
class Partitioner(Protocol):
    """The partition of a change among ``parts``."""

    def partition(self, changes: DataFrame, parts: int) -> Column: ...


def apply(changes: DataFrame, filters: list[RowFilter] = (), encoder: Encoder | None = None, partitioner: Partitioner | None = None, parts: int = 1) -> DataFrame:
    """Changes through the extensions: filtered, with ``message`` and ``part``."""
    for f in filters:
        changes = changes.where(f.keep(changes))
    added = {}
    if encoder is not None:
        added["message"] = encoder.encode(changes)
    if partitioner is not None:
        added["part"] = partitioner.partition(changes, parts)
    return changes.withColumns(added) if added else changes


def register_scalar(spark: SparkSession, name: str, f: Callable, returns: str) -> None:
    """``f(pandas.Series, ...) -> pandas.Series`` as a SQL function."""
    spark.udf.register(name, pandas_udf(f, returns, PandasUDFType.SCALAR))


def register_aggregate(spark: SparkSession, name: str, f: Callable, returns: str) -> None:
    """``f(pandas.Series, ...) -> value`` as a SQL aggregate. A group is in one
    task's memory, so it is for groups that are small by their nature."""
    spark.udf.register(name, pandas_udf(f, returns, PandasUDFType.GROUPED_AGG))


def register_table(spark: SparkSession, name: str, cls: type, returns: str) -> None:
    """A class with ``eval(...)`` that yields rows, as a SQL table function."""
    spark.udtf.register(name, udtf(cls, returnType=returns))
