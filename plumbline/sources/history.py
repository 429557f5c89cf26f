"""Folders to which runs add rows: each addition is written in parts and counts once it is committed."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.catalog import _exists

COMMITS = "run_id string, saved_at string, committed_at string, written_as string"


def add(
    spark: SparkSession, path: str, parts: Mapping[str, DataFrame], run_id: str = "", saved_at: str = ""
) -> str:
    """Write every part below a name of its own, then the commit; returns that name."""
    written_as = uuid.uuid4().hex
    for name, df in parts.items():
        df.write.parquet(f"{path}/{name}/written_as={written_as}")
    committed = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    commit = spark.createDataFrame([(run_id, saved_at, committed, written_as)], COMMITS)
    commit.coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return written_as


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The additions that are complete: one row each."""
    if not _exists(spark, f"{path}/commits/*.parquet"):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).parquet(f"{path}/commits")


def part(spark: SparkSession, path: str, name: str, schema: str, written_as: list[str]) -> DataFrame:
    """One part of the named additions; one that was not written has no rows."""
    folders = [f"{path}/{name}/written_as={one}" for one in written_as]
    found = [folder for folder in folders if _exists(spark, folder)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def latest(spark: SparkSession, path: str) -> str | None:
    """The name of the latest addition: by the time it was saved, then by that of its commit, then by run
    id. Ids are names and have no order of their own."""
    order = F.struct("saved_at", "committed_at", "run_id")
    return commits(spark, path).agg(F.max_by("written_as", order)).first()[0]
