"""Column references, kinds of Spark types and the single notion of "missing"."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC, DATE, BOOLEAN, STRING, OTHER = "numeric", "date", "boolean", "string", "other"


def ref(name: str) -> Column:
    """Reference a column whose name may hold hyphens, dots or backticks."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string as SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind_of(data_type: T.DataType) -> str:
    """The physical class of a Spark type: numeric, date, boolean, string or other."""
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return STRING
    return OTHER


def kinds(df: DataFrame) -> dict[str, str]:
    return {field.name: kind_of(field.dataType) for field in df.schema.fields}


def columns_of_kind(df: DataFrame, *wanted: str) -> list[str]:
    return [name for name, kind in kinds(df).items() if kind in wanted]


def is_float(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def normalise(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in float columns, so that one null test covers both."""
    if not any(is_float(f.dataType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.nanvl(ref(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if is_float(f.dataType)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def all_missing(columns: Iterable[str]) -> Column:
    """True for a row in which every column is null."""
    return reduce(lambda a, b: a & b, [ref(c).isNull() for c in columns])


def comparable(df: DataFrame, name: str) -> Column:
    """The column in a form that can be grouped and ordered (maps become entry arrays)."""
    column = ref(name)
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.sort_array(F.map_entries(column))
    return column


def orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(orderable(f.dataType) for f in data_type.fields)
    return True
