"""Profiles of growing tables: equal to the full profile, reading new files only."""

import hashlib
import os
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plumbline.operators import distinct, infer
from plumbline.plans import incremental
from plumbline.plans.incremental import profile_files
from plumbline.plans.profile import profile
from plumbline.sources import history

SCHEMA = (
    "id string, kind string, amount double, whole int, price string, day string, moment timestamp_ntz, flag boolean, "
    "note string, empty string, exact decimal(20,4), tags array<string>, `odd.name` float"
)


def rows(seed, n):
    rng = random.Random(seed)
    return [
        (
            f"K-{seed}-{k}", rng.choice(["a", "b", "c", None]), rng.choice([None, float("nan"), rng.gauss(0, 10**6), 0.5]),
            rng.randint(-5, 5), rng.choice([f"{rng.random():.3f}", "-7", "N/A", " 12 "]) if rng.random() < 0.98 else "x" * 70,
            rng.choice(["2024-01-05", "31/12/2023", "05-Jan-2030"]), None, rng.choice([True, False, None]),
            rng.choice(["long text " * 20 + str(k % 3), "0" * 80 + "1", "short\x07", "short"]), None, None, ["t"], 1.5,
        )
        for k in range(n)
    ]


def write(spark, path, seed, n):
    df = spark.createDataFrame(rows(seed, n), SCHEMA)
    df = df.withColumn("moment", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, length(id))"))
    df.coalesce(1).write.mode("append").parquet(path)


FACTS = [
    "row_count", "null_count", "num_min", "num_max", "num_mean", "num_std", "negative_count", "date_min", "date_max",
    "date_future", "unique_count", "repeated_rows", "inferred_type", "is_likely_pk", "is_likely_fk", *distinct.TEXT_TESTS,
]


def close(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 1e-9 * max(1, abs(a), abs(b)))


def check(spark, path, found, as_of):
    table = {"t": spark.read.parquet(path)}
    full = {r["column"]: r.asDict() for r in infer.infer_columns({"t": distinct_normal(table["t"])}, as_of).collect()}
    whole = {r["column"]: r for r in profile(table, as_of, stages=("distinct", "values", "samples")).rows}
    got = {r["column"]: r.asDict() for r in found.columns.collect()}
    assert set(got) == set(full)
    for column, row in got.items():
        for fact in FACTS:
            expected = full[column][fact]
            if full[column]["kind"] == "string" and fact.startswith(("num_", "date_min", "date_max", "date_future", "negative")):
                expected = whole[column][fact]
                row[fact] = round(row[fact], 6) if isinstance(row[fact], float) else row[fact]
                if expected in (0, None) and row[fact] in (0, None):
                    continue
            assert close(row[fact], expected), (column, fact, row[fact], expected)
    top = {}
    for r in found.top_values().orderBy("column", "rank").collect():
        top.setdefault(r["column"], []).append((r["value"], r["n"]))
    listed = {c: [(v["value"], v["count"]) for v in r["top_values"]] for c, r in whole.items() if r["top_values"]}
    shown = lambda v: v if len(v) < 64 or v.isdigit() else hashlib.sha256(v.encode()).hexdigest()
    assert top.keys() == listed.keys()
    for column, values in listed.items():  # long text shows as its digest, so ties may change places
        in_order = sorted if column == "note" else list
        assert in_order(top[column]) == in_order((shown(v), n) for v, n in values), column
    least = {}
    for r in found.smallest_values().orderBy("column", "rank").collect():
        least.setdefault(r["column"], []).append(r["value"])
    for column, values in least.items():
        if column != "note" and whole[column]["inferred_type"] != "text":  # it has long text
            assert values == whole[column]["sample_values"], column


def distinct_normal(df):
    from plumbline.functions.columns import normalise

    return normalise(df)


def test_equal_to_the_full_profile_and_reads_new_files_only(spark, tmp_path):
    source, state, as_of = f"{tmp_path}/rows", f"{tmp_path}/state", "2024-01-08"
    seen: set[str] = set()
    for seed, n in ((1, 120), (2, 60)):
        write(spark, source, seed, n)
        found = profile_files(spark, source, state, "t", as_of)
        names = {Path(p).name for p in found.read}
        assert len(names) == 1 and not names & seen
        seen |= names
        check(spark, source, found, as_of)
    again = profile_files(spark, source, state, "t", as_of)
    assert again.read == []
    check(spark, source, again, as_of)


def test_known_files_are_not_opened(spark, tmp_path):
    source, state = f"{tmp_path}/rows", f"{tmp_path}/state"
    write(spark, source, 1, 50)
    before = profile_files(spark, source, state, "t").columns.collect()
    (old,) = Path(source).glob("part-*.parquet")
    times = os.stat(old).st_atime_ns, os.stat(old).st_mtime_ns
    old.write_bytes(b"x" * old.stat().st_size)  # not Parquet any more, but known by time and size
    os.utime(old, ns=times)
    after = profile_files(spark, source, state, "t")
    assert after.read == [] and after.columns.collect() == before
    write(spark, source, 2, 50)
    rows_now = {r["column"]: r["row_count"] for r in profile_files(spark, source, state, "t").columns.collect()}
    assert set(rows_now.values()) == {100}


def test_files_that_are_gone_or_written_anew(spark, tmp_path):
    source, state = f"{tmp_path}/rows", f"{tmp_path}/state"
    for seed in (1, 2, 3):
        write(spark, source, seed, 40)
    profile_files(spark, source, state, "t", "2024-01-08")
    files = sorted(Path(source).glob("part-*.parquet"))
    files[0].unlink()
    (Path(source) / f".{files[0].name}.crc").unlink(missing_ok=True)
    other = f"{tmp_path}/other"
    write(spark, other, 9, 15)
    (new,) = Path(other).glob("part-*.parquet")
    (Path(source) / f".{files[1].name}.crc").unlink(missing_ok=True)
    files[1].write_bytes(new.read_bytes())
    found = profile_files(spark, source, state, "t", "2024-01-08")
    assert [Path(p).name for p in found.read] == [files[1].name]
    check(spark, source, found, "2024-01-08")
    assert {r["row_count"] for r in found.columns.collect()} == {55}


def test_a_run_broken_off_leaves_nothing(spark, tmp_path, monkeypatch):
    source, state = f"{tmp_path}/rows", f"{tmp_path}/state"
    write(spark, source, 1, 30)

    def broken(session, path, parts, *rest):
        parts["facts"].write.parquet(f"{path}/facts/written_as=broken")
        parts["files"].write.parquet(f"{path}/files/written_as=broken")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(history, "add", broken)
        with pytest.raises(RuntimeError, match="lost"):
            profile_files(spark, source, state, "t")
    found = profile_files(spark, source, state, "t")
    assert len(found.read) == 1 and {r["row_count"] for r in found.columns.collect()} == {30}


def test_no_rows(spark, tmp_path):
    source, state = f"{tmp_path}/rows", f"{tmp_path}/state"
    spark.createDataFrame([], "a string, b double").write.parquet(source)
    found = profile_files(spark, source, state, "t")
    assert found.columns.count() == 0  # a file without rows has no facts


def test_no_task_groups_a_whole_file(spark, tmp_path, monkeypatch):
    """Values of one large file are grouped by many tasks, and nothing is sorted for a count of columns."""
    monkeypatch.setattr(incremental, "CELLS", 500, raising=False)
    n = 4000
    df = spark.range(n).selectExpr("id", "id % 3 AS number", "CAST(id / 7 AS STRING) AS file", "CAST(id % 11 AS STRING) AS position")
    path = str(tmp_path / "rows")
    df.coalesce(1).write.parquet(path)
    plain, dealt = history.add, []

    def add(session, state, parts):
        scan = parts["values"]._jdf.queryExecution().toString()
        dealt.extend(int(k) for k in re.findall(r"RepartitionByExpression \[[^]]*\], (\d+)", scan))
        return plain(session, state, parts)

    monkeypatch.setattr(incremental.history, "add", add)
    found = profile_files(spark, path, str(tmp_path / "state"), "t")
    assert max(dealt, default=1) >= n * 2 // 500
    sizes = [r["count"] for r in found.values.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2 * n + 3 + 11 and max(sizes) < 2 * 500
    assert "SortAggregate" not in incremental._counted(found.values)._jdf.queryExecution().executedPlan().toString()
    unique = {r["column"]: (r["row_count"], r["unique_count"], r["repeated_rows"]) for r in found.columns.collect()}
    assert unique == {"id": (n, n, 0), "number": (n, 3, n), "file": (n, n, 0), "position": (n, 11, n)}
