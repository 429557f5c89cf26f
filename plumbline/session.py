"""Small helpers around the Spark session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """Union as a balanced tree: each step analyses a plan, so a chain would be quadratic."""
    level = list(parts)
    while len(level) > 1:
        level = [
            level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i]
            for i in range(0, len(level), 2)
        ]
    return level[0]


CONCURRENT_JOBS = 6


def together(spark: SparkSession, *tasks: Callable) -> list:
    """Run independent jobs at the same time, so that one fills the executors while another
    waits for its last tasks. Results come in the order of the tasks."""
    if len(tasks) < 2:
        return [task() for task in tasks]
    with ThreadPoolExecutor(min(CONCURRENT_JOBS, len(tasks))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [future.result() for future in started]


def pin(df: DataFrame) -> DataFrame:
    """Evaluate a result whose size is bounded by the schema (one row per table, column,
    column pair or finding) and hand it back as a local relation.

    Never used on rows of the data.
    """
    spark = df.sparkSession
    return spark.createDataFrame(df.toArrow(), schema=df.schema)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut points: the cluster's own setting, or, only on a local
    master without one, a fresh temporary folder."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="plumbline-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write a data-sized intermediate to the checkpoint folder and read it from there on."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
