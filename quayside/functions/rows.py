"""Choosing one whole row of several, whatever the types of its columns are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_no_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_no_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_no_order(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def last_row(columns: Sequence[str], schema: T.StructType) -> Column:
    """Aggregate: the last row as a struct, by its columns in turn, nulls first. A column that has no order, a map or
    a variant or something that holds one, counts by its JSON text."""
    row = F.struct(*columns)
    odd = {c for c in columns if _has_no_order(schema[c].dataType)}
    if not odd:
        return F.max(row)

    def text(name: str) -> Column:
        # Only the value itself of a variant is JSON; others are a field of a document.
        if isinstance(schema[name].dataType, T.VariantType):
            return F.to_json(F.col(name)).alias(name)
        return F.when(F.col(name).isNotNull(), F.to_json(F.struct(name))).alias(name)

    return F.max_by(row, F.struct(*[text(c) if c in odd else F.col(c) for c in columns]))
