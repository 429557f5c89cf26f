"""Lookups and duplicates where one key or one row holds most of the table."""

from pyspark.sql import functions as F

from plumbline.operators import duplicates, remediate, skew
from plumbline.plans.quality import run_quality


def hot_rows(spark):
    """90 % of the rows on one key, some on null, the others on keys of their own."""
    return spark.range(20_000).select(
        "id",
        F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 100 == 99, None)
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
    )


def reference(spark):
    return spark.createDataFrame([("hot", 1), ("k9", 2), ("k19", 3), ("unused", 4)], "code string, v int")


def test_lookup_beyond_the_broadcast_bound(spark):
    rows, known = hot_rows(spark), reference(spark)
    wanted = rows.join(known, rows["key"] == known["code"], "left")
    for bound in (0, 10):
        got = skew.lookup(rows, known, [("key", "code")], broadcast_rows=bound)
        assert got.count() == wanted.count() == 20_000
        assert got.exceptAll(wanted).isEmpty()


def test_null_safe_lookup(spark):
    rows = hot_rows(spark)
    known = spark.createDataFrame([("hot", 1), (None, 2), ("k9", 3)], "code string, v int")
    got = skew.lookup(rows, known, [("key", "code")], null_safe=True, broadcast_rows=0)
    found = {r["v"]: r["n"] for r in got.groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert found == {1: 18_000, 2: 200, 3: 1, None: 1799}


def test_hot_rows_are_not_shuffled(spark):
    """Only rows of other keys reach the shuffled join."""
    got = skew.lookup(hot_rows(spark), reference(spark), [("key", "code")], broadcast_rows=0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_marks_on_hot_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    rows, known = hot_rows(spark), reference(spark)
    marked = remediate.mark_mapped(rows, known.withColumnRenamed("code", "key"), ["key"])
    assert marked.where("`is-mapped`").count() == 18_002
    mapped, unmapped = remediate.split_mapped(rows, known.withColumnRenamed("code", "key"), ["key"])
    assert (mapped.count(), unmapped.count()) == (18_002, 1_998)
    assert mapped.columns == rows.columns
    valued = remediate.mark_reference_data(rows, "key", known, "code", "v")
    assert valued.where("`has-reference-data`").count() == 18_002
    flagged = duplicates.flag_duplicates(rows, ["key"], "id")
    assert flagged.where("`is-duplicate`").count() == 18_200
    assert flagged.where("`version-flag` = 'LATEST'").count() == 1_802


def test_duplicates_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "BROADCAST_ROWS", -1)
    rows = spark.range(100_000).selectExpr("CASE WHEN id < 99990 THEN 0 ELSE id END AS a", "'x' AS b")
    found = duplicates.duplicate_groups(rows)
    assert [tuple(r) for r in found.collect()] == [(0, "x", 99_990)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_count" in plan


def test_tables_are_cleaned_on_access(spark):
    rows = [(f"2024-01-{d:02}", 1.0 * d if d % 3 else None) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "day string, x double").withColumn("day", F.col("day").cast("date"))
    run = run_quality({"t": df}, as_of="2024-12-31")
    assert run.cleaned._built == {} and list(run.cleaned) == ["t"] and "u" not in run.cleaned
    assert run.cleaned["t"].where("x IS NULL").count() == 0
    assert run.unknown_values.collect() == []
    assert {(r["section"], r["measure"]): r["value"] for r in run.summary.collect()}["table", "rows"] == 28
