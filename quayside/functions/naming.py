"""camelCase to snake_case, for text, nested column types, maps and JSON documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word boundaries of camelCase, applied in this order.
BOUNDARIES = (r"([a-z0-9])([A-Z])", r"([A-Z]+)([A-Z][a-z])")


def camel_to_snake(c: Column) -> Column:
    for boundary in BOUNDARIES:
        c = F.regexp_replace(c, boundary, "$1_$2")
    return F.lower(c)


def snake_name(name: str) -> str:
    """The same rule for names known when the plan is built (column and struct field names)."""
    for boundary in BOUNDARIES:
        name = re.sub(boundary, r"\1_\2", name)
    return name.lower()


def snake_case_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [
                T.StructField(snake_name(f.name), snake_case_type(f.dataType), f.nullable)
                for f in dtype.fields
            ]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(snake_case_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, snake_case_type(dtype.valueType), dtype.valueContainsNull)
    return dtype


def _rename_map_keys(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):
        values = F.transform_values(c, lambda _, v: _rename_map_keys(v, dtype.valueType))
        return F.transform_keys(values, lambda k, _: camel_to_snake(k))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda item: _rename_map_keys(item, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [_rename_map_keys(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(_has_map(f.dataType) for f in dtype.fields)


def snake_case_schema(df: DataFrame) -> DataFrame:
    """Rename every column and nested struct field, and the keys of map columns.

    Struct fields cost nothing per row: the rename is a cast to the renamed type.
    """
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if _has_map(field.dataType):
            c = _rename_map_keys(c, field.dataType)
        columns.append(c.cast(snake_case_type(field.dataType)).alias(snake_name(field.name)))
    return df.select(*columns)


def snake_case_json(document: Column) -> Column:
    """Rename the keys of a JSON text at every depth.

    A key is a quoted string in front of a colon; whole string literals are consumed first, so
    quoted text inside values is never taken for a key. Escaped backslashes and quotes are kept out of the way as
    control characters, which JSON text cannot hold: then a literal is a run without quotes, and matching it
    takes no stack, however long it is.
    """
    hidden = F.replace(F.replace(document, F.lit("\\\\"), F.lit("\x02")), F.lit('\\"'), F.lit("\x01"))
    token = r'("[^"]*+"\s*+:|"[^"]*+"|[^"]++)'
    pieces = F.regexp_extract_all(hidden, F.lit(token), F.lit(1))
    is_key = lambda piece: piece.startswith('"') & piece.endswith(":")
    renamed = F.array_join(
        F.transform(pieces, lambda p: F.when(is_key(p), camel_to_snake(p)).otherwise(p)), ""
    )
    return F.replace(F.replace(renamed, F.lit("\x01"), F.lit('\\"')), F.lit("\x02"), F.lit("\\\\"))
