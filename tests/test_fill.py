"""Forward fill against pandas, with dates that hold most rows."""

import random

import pandas as pd
import pytest

from plumbline.operators import ordered


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        day = None if rng.random() < 0.05 else 5 if rng.random() < 0.6 else rng.randint(0, 40)
        out.append((k, day, rng.choice([None, None, float(k)]), rng.choice([None, k])))
    rng.shuffle(out)
    return out


def by_pandas(given):
    df = pd.DataFrame(given, columns=["id", "day", "x", "y"])
    df = df.sort_values(["day", "id"], na_position="last")
    df[["x", "y"]] = df[["x", "y"]].ffill()
    return {int(r.id): tuple(None if pd.isna(v) else float(v) for v in (r.x, r.y)) for r in df.itertuples()}


@pytest.mark.parametrize("heavy", [1, 50, 10**9])
def test_fill_as_pandas(spark, monkeypatch, heavy):
    monkeypatch.setattr(ordered, "MIN_HEAVY", heavy)
    given = rows(600, heavy)
    df = spark.createDataFrame(given, "id int, day int, x double, y int").repartition(5)
    found = ordered.forward_fill(df, "day", ["x", "y"], buckets=4).collect()
    got = {r["id"]: tuple(None if v is None else float(v) for v in (r["x"], r["y"])) for r in found}
    assert got == by_pandas(given)


def test_copies_of_one_row_on_one_date(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MIN_HEAVY", 10)
    df = spark.createDataFrame([(1, None)] * 500 + [(1, 7.0)] * 3 + [(0, 2.0), (2, None)], "day int, x double")
    found = ordered.forward_fill(df, "day", ["x"], buckets=4).groupBy("day", "x").count().collect()
    assert sum(r["count"] for r in found) == 505
    assert {r["x"] for r in found if r["day"] == 2} <= {2.0, 7.0} and not any(r["x"] is None for r in found)


def test_rows_are_shuffled_once(spark):
    df = spark.createDataFrame(rows(600, 2), "id int, day int, x double, y int")
    filled = ordered.forward_fill(df, "day", ["x", "y"])
    plan = filled._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(wide) == 1 and "Join" not in plan


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, day int, x double, y int")
    assert ordered.forward_fill(df, "day", ["x", "y"]).collect() == []
