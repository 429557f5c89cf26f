"""Row counts, null counts and bounds from the footers of Parquet files, without reading their rows.

Counts and bounds of whole files stand in their footers. The file source answers an aggregate from them if
every part of it can be answered so. That holds for the number of rows, for nulls of all flat columns, and
for the bounds of whole numbers and dates. It does not for fractions (NaN, which is missing here, isn't told
from other values), for moments, decimals and text, nor for files whose writer left statistics
out: those columns, and only those, are scanned."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, time

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.functions.columns import DATE, NUMERIC, kind_of, normalise, quoted
from plumbline.session import together

#: The aggregate pushdown belongs to the newer of the two file sources.
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
SCHEMA = (
    "table string, column string, position int, kind string, row_count bigint, null_count bigint, "
    "num_min double, num_max double, date_min timestamp_ntz, date_max timestamp_ntz, from_footer boolean"
)
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same cluster whose file source answers aggregates from footers."""
    session = spark.newSession()
    for name, value in SETTINGS.items():
        session.conf.set(name, value)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def _aggregates(field: T.StructField) -> dict[str, str]:
    """What the footers can tell of a column."""
    column, bounded = quoted(field.name), isinstance(field.dataType, BOUNDED)
    if isinstance(field.dataType, NESTED) or (kind_of(field.dataType) in (NUMERIC, DATE) and not bounded):
        return {}
    found = {"filled": f"count({column})"}
    return found | {"low": f"min({column})", "high": f"max({column})"} if bounded else found


def pushed(df: DataFrame) -> bool:
    """Whether an aggregate over files is answered by their footers."""
    return "PushedAggregation: [COUNT" in df._jdf.queryExecution().executedPlan().toString()


def asked(df: DataFrame, fields: Iterable[T.StructField]) -> DataFrame:
    """One row with the number of rows and what footers can tell of these columns, named by number."""
    return df.selectExpr(
        "count(1) AS row_count",
        *[f"{e} AS `{i}_{name}`" for i, f in enumerate(fields) for name, e in _aggregates(f).items()],
    )


def _answers(df: DataFrame, fields: list[T.StructField]) -> dict[str, dict]:
    """The answers of the footers by column. Where they lack something for all columns at once, the
    columns are asked one by one; those without an answer are left out."""
    query = asked(df, fields)
    if pushed(query):
        try:
            row = query.first()
        except (PySparkException, Py4JJavaError) as error:
            if "aggregatePushdown" not in str(error):
                raise
            row = None  # a file lacks these statistics
        if row is not None:
            return {
                f.name: {"row_count": row["row_count"] or 0}  # null if no file has a row
                | {name: row[f"{i}_{name}"] for name in _aggregates(f)}
                | {"filled": row[f"{i}_filled"] or 0}
                for i, f in enumerate(fields)
            }
    if len(fields) < 2:
        return {}
    half = len(fields) // 2
    return _answers(df, fields[:half]) | _answers(df, fields[half:])


def _scanned(df: DataFrame, fields: list[T.StructField]) -> dict[str, dict]:
    """The same facts of the other columns, by one scan that reads only them."""
    if not fields:
        return {}
    rows = normalise(df.select(*[quoted(f.name) for f in fields]))
    parts = []
    for i, f in enumerate(fields):
        column = quoted(f.name)
        parts.append(f"count({column}) AS `{i}_filled`")
        if kind_of(f.dataType) in (NUMERIC, DATE):
            value = f"CAST({column} AS TIMESTAMP_NTZ)" if kind_of(f.dataType) == DATE else column
            parts += [f"min({value}) AS `{i}_low`", f"max({value}) AS `{i}_high`"]
    row = rows.selectExpr("count(1) AS row_count", *parts).first().asDict()
    return {
        f.name: {"row_count": row["row_count"]}
        | {name: row.get(f"{i}_{name}") for name in ("filled", "low", "high")}
        for i, f in enumerate(fields)
    }


def table_footers(spark: SparkSession, table: str, path: str | list[str]) -> list[dict]:
    """The facts of every column of one table of Parquet files."""
    paths = [path] if isinstance(path, str) else list(path)
    df = footer_session(spark).read.parquet(*paths)
    fields = df.schema.fields
    answered = _answers(df, [f for f in fields if _aggregates(f)])
    known = answered | _scanned(df, [f for f in fields if f.name not in answered])
    out = []
    for position, f in enumerate(fields):
        facts, kind = known[f.name], kind_of(f.dataType)
        row = {
            "table": table, "column": f.name, "position": position, "kind": kind,
            "row_count": facts["row_count"], "null_count": facts["row_count"] - facts["filled"],
            "from_footer": f.name in answered,
        }
        for end, side in (("min", "low"), ("max", "high")):
            value = facts.get(side)
            if kind == NUMERIC and value is not None:
                row[f"num_{end}"] = float(value)
            if kind == DATE and value is not None:
                row[f"date_{end}"] = _moment(value)
        out.append(row)
    return out


def _moment(value: date) -> datetime:
    """A date, or a moment as the scan gave it, without zone."""
    return value if isinstance(value, datetime) else datetime.combine(value, time())


def footer_facts(spark: SparkSession, paths: Mapping[str, str | list[str]]) -> DataFrame:
    """One row per column of each table of Parquet files: rows, nulls, bounds, and whether the footers
    told them. NaN counts as missing."""
    found = together(spark, *[lambda t=t, p=p: table_footers(spark, t, p) for t, p in paths.items()])
    rows = [row for part in found for row in part]
    empty = spark.createDataFrame([], SCHEMA)
    if not rows:
        return empty
    data = [{name: row.get(name) for name in empty.columns} for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(data, schema=to_arrow_schema(empty.schema)), schema=empty.schema)
