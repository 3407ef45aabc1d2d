"""Reading a field as a double the way a text parser would."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def field_or_null(df: DataFrame, name: str) -> Column:
    """The column, or a null literal where this schema version lacks it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def is_text(df: DataFrame, name: str) -> bool:
    return name not in df.columns or isinstance(df.schema[name].dataType, T.StringType)


def as_double(df: DataFrame, name: str) -> Column:
    """Null where the value is missing or no number. Floats go through their
    shortest text, so 0.1 stays 0.1."""
    column = field_or_null(df, name)
    if name not in df.columns:
        return column.try_cast("double")
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.FloatType):
        return column.cast("string").cast("double")
    if isinstance(dtype, T.NumericType):
        return column.cast("double")
    if isinstance(dtype, T.StringType):
        return column.try_cast("double")
    return F.lit(None).cast("double")
