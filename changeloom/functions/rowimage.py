"""Column expressions over the row images of a redo log.

An image is ``array<struct<col_name, ..., col_value, flag>>``. An empty array
and null both mean that the image is absent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HANDLE_KEY = 2  # flag bit of a handle-key column


def present(image: Column) -> Column:
    return F.coalesce(F.size(image), F.lit(0)) > 0


def op_code(row: Column, pre: Column) -> Column:
    """I without the old image, D without the new one, U with both, else null."""
    return (
        F.when(present(row) & present(pre), F.lit("U"))
        .when(present(row), F.lit("I"))
        .when(present(pre), F.lit("D"))
    )


def image_key(image: Column) -> Column:
    """Handle-key values in the order of their column names, joined with ``|``;
    a null value counts as an empty string."""
    keys = F.filter(image, lambda c: c["flag"].bitwiseAND(HANDLE_KEY) != 0)
    pairs = F.array_sort(F.transform(keys, lambda c: F.struct(c["col_name"].alias("n"), c["col_value"].alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: F.coalesce(p["v"], F.lit(""))), "|")


def row_key(row: Column, pre: Column) -> Column:
    """Key of the new image, or of the old one where only that is present."""
    return image_key(F.when(present(row), row).otherwise(pre))


def image_json(image: Column) -> Column:
    """The whole image as a JSON list of its fields, types and flags included,
    nulls left out; null if absent."""
    return F.when(present(image), F.to_json(image))


def clean_name(name: Column) -> Column:
    """A table or schema name in lower case, without backticks and outer spaces."""
    return F.lower(F.trim(F.regexp_replace(F.trim(name), "`", "")))


def scan_schema(schema: T.StructType, images: tuple[str, ...] = ("row_columns", "pre_columns")) -> T.StructType:
    """The log's schema with only the parts of an image that are used here, so
    that a scan for keys does not read types, charsets and collations. (Functions over
    the elements of an array keep the optimizer from seeing this by itself.)"""
    used = ("col_name", "col_value", "flag")
    fields = []
    for f in schema.fields:
        if f.name in images and isinstance(f.dataType, T.ArrayType):
            part = T.StructType([x for x in f.dataType.elementType.fields if x.name in used])
            f = T.StructField(f.name, T.ArrayType(part, f.dataType.containsNull), f.nullable)
        fields.append(f)
    return T.StructType(fields)
