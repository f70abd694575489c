"""The unified record, column roles and the one notion of "missing"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIFIED_COLUMNS = ["text", "audio", "image", "label", "source", "collected_at"]
UNIFIED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in UNIFIED_COLUMNS])

# Candidate column names, first present wins.
TEXT_ROLES = ("text", "Text", "content", "review", "sentence")
LABEL_ROLES = ("label", "Label", "target", "class", "sentiment")


def _first_present(df: DataFrame, names) -> str | None:
    return next((n for n in names if n in df.columns), None)


def text_role(df: DataFrame) -> str | None:
    return _first_present(df, TEXT_ROLES)


def label_role(df: DataFrame) -> str | None:
    return _first_present(df, LABEL_ROLES)


def role_columns(df: DataFrame) -> list[str]:
    """The text and label columns that exist, in that order."""
    return [c for c in (text_role(df), label_role(df)) if c]


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Integer, floating and decimal columns; booleans are not numeric."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def with_fraction(dtype: T.DataType, digits: int) -> T.DataType:
    """The type of a numeric column's values with ``digits`` more decimal places.

    Floating columns become double. Integers and decimals stay exact; where 38 digits would not do,
    the places are fewer.
    """
    if is_floating(dtype):
        return T.DoubleType()
    whole, places = {T.ByteType: (3, 0), T.ShortType: (5, 0), T.IntegerType: (10, 0), T.LongType: (19, 0)}.get(
        type(dtype)) or (dtype.precision - dtype.scale, dtype.scale)
    places = min(places + digits, 38 - whole)
    return T.DecimalType(whole + places, places)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns."""
    c = F.col(f"`{name}`")
    return (c.isNull() | F.isnan(c)) if is_floating(df.schema[name].dataType) else c.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null once, so every later operator sees one kind of missing."""
    floats = {f.name for f in df.schema.fields if is_floating(f.dataType)}
    if not floats:
        return df
    return df.select([
        F.nanvl(F.col(f"`{c}`"), F.lit(None).cast(df.schema[c].dataType)).alias(c)
        if c in floats else F.col(f"`{c}`") for c in df.columns])
