"""Outputs: cleaned tables, findings, dictionary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import columns_of_kind, ref

FORMATS = ("csv", "parquet")


NESTED = ("array", "map", "struct")


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, the only form that a delimited file can hold."""
    return df.select(
        *[
            F.to_json(ref(f.name)).alias(f.name) if f.dataType.typeName() in NESTED else ref(f.name)
            for f in df.schema.fields
        ]
    )


def write_cleaned(
    cleaned: Mapping[str, DataFrame], sources: Mapping[str, Mapping], folder: str
) -> list[str]:
    """One output per source, in the format of the source, written in parallel part files.

    Spaces around values and line breaks in them survive; a null and an empty text are one."""
    paths = []
    for name, source in sources.items():
        if name not in cleaned:
            continue
        kind = source["type"] if source["type"] in FORMATS else "parquet"
        path = f"{folder}/cleaned_{name}"
        if kind == "csv":
            _flat(cleaned[name]).write.mode("overwrite").csv(
                path, header=True, sep=source.get("delimiter", ","), escape='"',
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            )
        else:
            cleaned[name].write.mode("overwrite").parquet(path)
        paths.append(path)
    return paths


def write_results(findings: DataFrame, path: str) -> None:
    """Findings as JSON lines; an empty column shows as a dash."""
    dates = columns_of_kind(findings, "date")
    out = findings.withColumn("column", F.coalesce("column", F.lit("—")))
    out = out.withColumns({c: ref(c).cast("string") for c in dates}) if dates else out
    out.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
