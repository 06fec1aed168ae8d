"""JSON payloads: strict typed access to fields and content hashes.

Spark's JSON readers stop after the first value and accept single quotes; here a text counts only
when it is exactly one JSON value. To see that, the text is read as first element of an array
whose second element is a marker made from the text itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Delivery metadata that does not belong to the content of a submission.
DELIVERY_FIELDS = ("received_at", "correlation_id", "retry_count", "source_ip")

# Fields every pipeline payload must carry, in message order.
PIPELINE_REQUIRED = ("company_id", "company_name", "revenue", "industry", "state")

_STRICT = {"allowSingleQuotes": "false"}
_END = "_end"
# A number that VARIANT may round: with an exponent, or with more than 37 digits and points.
_INEXACT = r"((?:\d[\d.]*+[eE][+-]?\d++)|(?:\d[\d.]{37,}+))"
# One of these is in every text that has such a number. They go over a text at half the time.
_MAYBE_INEXACT = (r"[eE][+-]?[0-9]", r"[0-9.]{38}")
IS_OBJECT = "is_object"


def _marker(text: Column) -> Column:
    return F.hex(F.xxhash64(text))


def with_content_key(
    df: DataFrame, payload: str, key: str, exclude: Iterable[str] = DELIVERY_FIELDS
) -> DataFrame:
    """Add the hex SHA-256 of the payload without the excluded top-level fields.

    Field order does not matter: VARIANT objects keep their keys sorted at every level, so
    writing one out is canonical. Text that is no JSON object is hashed as it is. VARIANT holds numbers with an
    exponent or of over 38 digits as DOUBLE; such numbers are hashed besides, as they are written.
    """
    exclude = tuple(exclude)
    text = F.col(payload)
    array = F.concat(F.lit("["), text, F.lit(',"'), _marker(text), F.lit('"]'))
    read = df.withColumn("_read", F.from_json(array, "array<variant>", _STRICT))
    whole = (F.size("_read") == 2) & (
        F.try_variant_get(F.get("_read", F.lit(1)), "$", "string") == _marker(text)
    )
    # Null unless the value is an object. Its fields one by one are written faster than the whole of it.
    fields = F.try_variant_get(F.get("_read", F.lit(0)), "$", "map<string,variant>")
    if exclude:
        fields = F.map_filter(fields, lambda name, _: ~name.isin(*exclude))
    content = F.to_json(fields)
    exponent, digits = map(text.rlike, _MAYBE_INEXACT)
    inexact = F.array_join(F.array_sort(F.regexp_extract_all(text, F.lit(_INEXACT), F.lit(1))), " ")
    listed = F.when(F.when(exponent | digits, text.rlike(_INEXACT)), F.concat(F.lit("\n"), inexact)).otherwise("")
    canonical = F.when(whole, F.concat(content, listed))
    # Never null, so that joins on the key add no null filter; pushed down, that filter would
    # parse and hash every payload again.
    hashed = F.coalesce(F.sha2(F.coalesce(canonical, text), 256), F.lit(""))
    return read.withColumn(key, hashed).drop("_read")


@dataclass(frozen=True)
class Field:
    """A source value as text plus its shape: STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN,
    OBJECT<..>, ARRAY<..>, VOID for a JSON null, and null when the field is absent."""

    text: Column
    shape: Column

    @property
    def is_string(self) -> Column:
        return F.coalesce(self.shape == "STRING", F.lit(False))

    @property
    def is_absent(self) -> Column:
        return self.shape.isNull()

    @property
    def is_missing(self) -> Column:
        return F.coalesce(self.shape == "VOID", F.lit(True))

    @property
    def is_boolean(self) -> Column:
        return F.coalesce(self.shape == "BOOLEAN", F.lit(False))

    @property
    def is_number(self) -> Column:
        named = self.shape.isin("BIGINT", "DOUBLE", "FLOAT") | self.shape.startswith("DECIMAL")
        return F.coalesce(named, F.lit(False))


def _text_name(name: str) -> str:
    return f"_{name}_text"


def _shape_name(name: str) -> str:
    return f"_{name}_shape"


def source_field(name: str) -> Field:
    """The columns added by ``with_payload_fields`` or ``with_column_fields``."""
    return Field(F.col(_text_name(name)), F.col(_shape_name(name)))


def drop_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(IS_OBJECT, *map(_text_name, names), *map(_shape_name, names))


def with_payload_fields(df: DataFrame, text: Column, names: Sequence[str]) -> DataFrame:
    """Split the named fields of a JSON object text into text and shape columns, and add
    ``is_object``: whether the text is one JSON object at all.

    The columns come out of a one-element generator. A later filter on them stays above it;
    pushed below, it would parse the text once for every mention of a field.
    """
    fields = ", ".join(f"{name}: variant" for name in names)
    schema = f"array<struct<{fields}, {_END}: string>>"
    source = F.col("_source")
    array = F.concat(
        F.lit("["), source, F.lit(f',{{"{_END}":"'), _marker(source), F.lit('"}]')
    )
    read = df.withColumn("_source", text).withColumn("_read", F.from_json(array, schema, _STRICT))
    whole = (F.size("_read") == 2) & (F.get("_read", F.lit(1))[_END] == _marker(source))
    first = read.withColumn("_object", F.when(whole, F.get("_read", F.lit(0))))
    parts = [F.col("_object").isNotNull().alias(IS_OBJECT)]
    for name in names:
        value = F.col("_object")[name]
        parts.append(F.try_variant_get(value, "$", "string").alias(_text_name(name)))
        parts.append(F.schema_of_variant(value).alias(_shape_name(name)))
    return first.select(*df.columns, F.inline(F.array(F.struct(*parts))))


def _column_shape(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "STRING"
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, T.DecimalType):
        return "DECIMAL"
    if isinstance(dtype, T.IntegralType):
        return "BIGINT"
    if isinstance(dtype, T.NumericType):
        return "DOUBLE"
    return "OBJECT"


def with_column_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same for fields held in columns of their own; the shape comes from the column type."""
    parts = {}
    for name in names:
        if name not in df.columns:
            parts[_text_name(name)] = F.lit(None).cast("string")
            parts[_shape_name(name)] = F.lit(None).cast("string")
        elif isinstance(df.schema[name].dataType, T.VariantType):
            parts[_text_name(name)] = F.try_variant_get(name, "$", "string")
            parts[_shape_name(name)] = F.schema_of_variant(name)
        else:
            shape = _column_shape(df.schema[name].dataType)
            text = F.to_json(name) if shape == "OBJECT" else F.col(name).cast("string")
            parts[_text_name(name)] = text
            parts[_shape_name(name)] = F.when(F.col(name).isNotNull(), shape)
    return df.withColumns(parts)


def missing_required(names: Sequence[str]) -> Column:
    """Quoted, comma-separated names of fields that are absent, null or exactly empty; empty
    text when there are none."""
    listed = []
    for name in names:
        field = source_field(name)
        empty = field.is_missing | (field.is_string & (field.text == ""))
        listed.append(F.when(empty, F.lit(f"'{name}'")))
    return F.concat_ws(", ", *listed)
