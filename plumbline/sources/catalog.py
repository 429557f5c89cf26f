"""Named sources: CSV and Parquet tables, lazily read."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plumbline import constants as K
from plumbline.functions.columns import STRING, kinds, literal, normalise, quoted, ref
from plumbline.functions.parsing import (
    INTEGER_PATTERN, anywhere_stripped, proves_day_first, proves_month_first, to_timestamp,
)

log = logging.getLogger(__name__)


class NoTables(ValueError):
    """No source of the configuration could be loaded."""


class MalformedSource(ValueError):
    """A delimited file whose records do not fit its header."""


def clean_header(name: str) -> str:
    return name.strip().lstrip("﻿")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path has data, asked of the file system that owns it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(system.globStatus(hadoop))


def missing_to_null(df: DataFrame) -> DataFrame:
    """Text tokens for missing values become nulls."""
    tokens = ", ".join(literal(t) for t in K.MISSING_TOKENS)
    column_kinds = kinds(df)
    return df.selectExpr(
        *[
            f"CASE WHEN {quoted(c)} IN ({tokens}) THEN NULL ELSE {quoted(c)} END AS {quoted(c)}"
            if column_kinds[c] == STRING and c != SURPLUS
            else quoted(c)
            for c in df.columns
        ]
    )


#: The column for what a record has beyond the header.
SURPLUS = "__surplus__"


def _has_open_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a line holds an odd number of quotes: a value may go on in the next line."""
    quotes = "length(value) - length(replace(value, '\"', ''))"
    return not spark.read.text(path).where(f"({quotes}) % 2 = 1").limit(1).isEmpty()


def _raw_csv(spark: SparkSession, path: str, delimiter: str, multiline: bool | None) -> DataFrame:
    """All columns as text, missing tokens as nulls, and `SURPLUS`: what a record has beyond the header."""
    if multiline is None:
        multiline = _has_open_quotes(spark, path)
    reader = spark.read.options(header=True, sep=delimiter, multiLine=multiline, escape='"')
    names = reader.csv(path).columns
    fields = [StructField(c, StringType()) for c in [*names, SURPLUS]]
    # the header is one field short of this schema, which is no mistake
    df = reader.option("enforceSchema", True).schema(StructType(fields)).csv(path)
    return missing_to_null(df.toDF(*[clean_header(c) for c in names], SURPLUS))


#: What the values of a text column may all be, with the type the column then gets, the narrowest first.
TYPE_VOTES = {
    "boolean": lambda c: F.lower(c).isin("true", "false"),
    "bigint": lambda c: c.rlike(INTEGER_PATTERN),
    "double": lambda c: c.rlike(anywhere_stripped((K.NUMBER_PATTERN, K.INFINITY_PATTERN))),
}


def _settled(df: DataFrame, dates: Iterable[str], typed: bool, path: str = "") -> DataFrame:
    """The columns in the types their values call for, after one scan for all that must be known before:
    surplus fields, which way declared dates are written and how many do not parse either way, and
    whether all values of a text column are truth values or numbers."""
    column_kinds = kinds(df)
    text = [c for c, k in column_kinds.items() if k == STRING and c != SURPLUS]
    declared = [c for c in dict.fromkeys(dates) if c in text]
    others = [c for c in text if c not in declared] if typed else []
    asked = {}
    if SURPLUS in df.columns:
        asked["surplus"] = F.count(ref(SURPLUS))
    for i, c in enumerate(declared):
        asked[f"month{i}"], asked[f"day{i}"] = (F.count_if(test(ref(c))) for test in (proves_month_first, proves_day_first))
        for way, month_first in (("lost_day", False), ("lost_month", True)):
            parsed = to_timestamp(ref(c), month_first=month_first)
            asked[f"{way}{i}"] = F.count_if(ref(c).isNotNull() & parsed.isNull())
    for i, c in enumerate(others):
        asked[f"filled{i}"] = F.count(ref(c))
        for name, test in TYPE_VOTES.items():
            asked[f"{name}{i}"] = F.count_if(test(ref(c)))
    if not asked:
        return df
    found = df.agg(*[value.alias(name) for name, value in asked.items()]).first()
    if found.asDict().get("surplus"):
        raise MalformedSource(f"{path}: {found['surplus']} record(s) have more fields than the header")
    settled = {}
    for i, c in enumerate(declared):
        # numbers that only fit month first, and none that only fit day first
        month_first = found[f"month{i}"] > 0 and found[f"day{i}"] == 0
        lost = found[f"lost_{'month' if month_first else 'day'}{i}"]
        if lost:
            log.warning("%d value(s) of date column %r do not parse", lost, c)
        settled[c] = to_timestamp(ref(c), month_first=month_first).alias(c)
    for i, c in enumerate(others):
        kind = next((name for name in TYPE_VOTES if 0 < found[f"filled{i}"] == found[f"{name}{i}"]), None)
        if kind:
            settled[c] = ref(c).cast(kind).alias(c)
    return df.select(*[settled.get(c, ref(c)) for c in df.columns if c != SURPLUS])


def read_csv(
    spark: SparkSession, path: str, delimiter: str = ",", multiline: bool | None = None
) -> DataFrame:
    """A delimited file with a header; all columns are text, missing tokens are null.

    Files in which a quoted value spans lines are read whole by one task each; `multiline` says
    so, or else the quotes of all lines are counted first. A record with more fields than the
    header is an error, not cut; one with fewer has nulls."""
    return _settled(_raw_csv(spark, path, delimiter, multiline), (), False, path)


def settle_types(df: DataFrame) -> DataFrame:
    """Text columns whose every value is a number or a truth value get that type; one scan decides for all."""
    return _settled(df, (), True)


def coerce_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Declared date columns; what does not parse becomes null and is counted in a warning.

    Dates are day first, unless a column holds numbers that only fit month first (`12/25/2022`)
    and none that only fit day first: then all of the column is read month first."""
    return _settled(df, columns, False)


def find_sources(spark: SparkSession, folder: str) -> dict[str, dict]:
    """The `sources` of a configuration for the delimited and Parquet files of a folder: a name made from
    the file name, and the delimiter the header line calls for. Other files are left out; of files
    that give one name the last by file name counts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    sources = {}
    for file in sorted(str(status.getPath().toString()) for status in system.listStatus(path)):
        stem, dot, kind = file.rsplit("/", 1)[-1].rpartition(".")
        name = stem.lower().replace(" ", "_").replace("-", "_")
        if not dot or kind.lower() not in ("csv", "parquet"):
            continue
        sources[name] = {"type": kind.lower(), "file": file}
        if kind.lower() == "csv":
            first = spark.read.text(file).first()
            line = first["value"] if first else ""
            sources[name]["delimiter"] = ";" if line.count(";") > line.count(",") else ","
    return sources


def _load(spark: SparkSession, source: Mapping, typed: bool) -> DataFrame:
    path, dates = str(source["file"]), source.get("date_columns", [])
    if source["type"] == "csv":
        raw = _raw_csv(spark, path, source.get("delimiter", ","), source.get("multiline"))
        return normalise(_settled(raw, dates, typed, path))
    return normalise(coerce_dates(spark.read.parquet(path), dates))


def load_tables(
    spark: SparkSession, config: Mapping, typed: bool = True, skip_errors: bool = False
) -> dict[str, DataFrame]:
    """The tables of the configuration. A missing file or an unknown type is skipped with a
    warning. A source that can't be read ends the load with an error that names it, or is skipped with a
    warning too if `skip_errors` is set. An error is raised if nothing is left."""
    tables = {}
    for name, source in config.get("sources", {}).items():
        path, kind = str(source["file"]), source["type"]
        if kind not in ("csv", "parquet"):
            log.warning("unknown source type %r: skipping %r", kind, name)
            continue
        if not _exists(spark, path):
            log.warning("file not found: %s: skipping %r", path, name)
            continue
        try:
            tables[name] = _load(spark, source, typed)
        except (PySparkException, Py4JJavaError, MalformedSource) as error:
            if not skip_errors:
                raise MalformedSource(f"source {name!r}: {error}") from error
            log.warning("can't read source %r, skipping it: %s", name, error)
    if not tables:
        raise NoTables("no source of the configuration could be loaded")
    return tables


def read_folder(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Parquet tables of one folder by name."""
    return {n: normalise(spark.read.parquet(f"{folder}/{n}.parquet")) for n in names}
