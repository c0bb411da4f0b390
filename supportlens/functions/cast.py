"""Forgiving casts of dirty source values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = r"^\s*[+-]?\d+\s*$"
_GROUPED = r"^\s*[+-]?\d+(_\d+)*\s*$"
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"
_FLAG = r"(?i)^\s*(t|true|y|yes|1|f|false|n|no|0)\s*$"


# A failing try_cast raises and catches inside Spark, some ten times the cost of the pattern that sorts such texts out.
def parse_long(text: Column) -> Column:
    return F.when(text.rlike(_WHOLE), text.try_cast("long"))


def parse_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_flag(text: Column) -> Column:
    return F.when(text.rlike(_FLAG), text.try_cast("boolean"))


def safe_cast(df: DataFrame, name: str, to: str, compat: bool = False) -> Column:
    """Column `name` as 'int', 'str' or 'bool'; what does not convert is null.

    compat=True keeps the source system's habits: a missing text reads 'None', a missing flag is false, and any
    non-empty text is a true flag. It needs the column's present type, hence the frame.
    """
    source, value = df.schema[name].dataType, F.col(name)
    if to == "int":
        return _to_int(value, source, compat)
    if to == "bool":
        return _to_bool(value, source, compat)
    if to == "str":
        return _to_str(value, source, compat)
    raise ValueError(f"unknown target {to!r}")


def _is_nested(source: T.DataType) -> bool:
    return isinstance(source, (T.ArrayType, T.MapType, T.StructType))


def _to_int(value: Column, source: T.DataType, compat: bool) -> Column:
    if _is_nested(source) or isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(None).cast("long")
    if isinstance(source, T.StringType):
        grouped = F.when(value.rlike(_GROUPED), F.replace(value, F.lit("_"), F.lit("")))
        return parse_long(grouped if compat else value)
    return value.try_cast("long")


def _to_bool(value: Column, source: T.DataType, compat: bool) -> Column:
    if _is_nested(source):
        return F.coalesce(F.size(value) > 0, F.lit(False)) if compat else F.lit(None).cast("boolean")
    if isinstance(source, T.StringType) and compat:
        return F.coalesce(value != "", F.lit(False))
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.isNotNull() if compat else F.lit(None).cast("boolean")
    flag = parse_flag(value) if isinstance(source, T.StringType) else value.try_cast("boolean")
    return F.coalesce(flag, F.lit(False)) if compat else flag


def _to_str(value: Column, source: T.DataType, compat: bool) -> Column:
    if _is_nested(source):
        return F.to_json(value)
    text = value.cast("string")
    if isinstance(source, T.BooleanType) and compat:
        text = F.initcap(text)
    return F.coalesce(text, F.lit("None")) if compat else text
