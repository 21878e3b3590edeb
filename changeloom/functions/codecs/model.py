"""Description of a table for the codecs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Col:
    """A column: its type as text and whether it belongs to the handle key;
    the names of an enum or set, the fraction digits of a time, the bits of a
    bit column."""

    name: str
    type: str = "bigint"
    key: bool = False
    nullable: bool = True
    elements: tuple[str, ...] = ()
    digits: int = 0
    bits: int = 1


@dataclass(frozen=True)
class Table:
    schema: str
    name: str
    columns: tuple[Col, ...]
    table_id: int = 0
    version: int = 0
    keys: tuple[str, ...] = field(default=(), compare=False)

    @property
    def handle(self) -> list[Col]:
        return [c for c in self.columns if c.key]


def image(prefix: str, cols, value) -> Column:
    """Struct of an image's columns, each through ``value(column, Column)``."""
    return F.struct(*[value(c, F.col(f"{prefix}_{c.name}")).alias(c.name) for c in cols])


def json(c: Column) -> Column:
    """JSON text that keeps null fields."""
    return F.to_json(c, {"ignoreNullFields": "false"})


#: Type numbers of the source database and column flags, fixed values.
TYPE_CODES = {"tinyint": 1, "smallint": 2, "int": 3, "float": 4, "double": 5, "timestamp": 7, "bigint": 8, "date": 10, "time": 11, "datetime": 12, "year": 13, "varchar": 15, "bit": 16, "json": 245, "decimal": 246, "enum": 247, "set": 248, "blob": 252, "char": 254}
FLAG_BINARY, FLAG_HANDLE, FLAG_GENERATED, FLAG_PRIMARY, FLAG_UNIQUE, FLAG_MULTIPLE, FLAG_NULLABLE, FLAG_UNSIGNED = (1 << i for i in range(8))


def flags(c: Col) -> int:
    return (FLAG_HANDLE | FLAG_PRIMARY if c.key else 0) | (FLAG_NULLABLE if c.nullable and not c.key else 0)
