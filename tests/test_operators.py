"""Operators against brute force on small fixtures, with hot keys and awkward edges."""

import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import (
    distinct, drift, duplicates, facts, infer, measures, ordered, relate, remediate, temporal,
)
from plumbline.operators import quantiles
from plumbline.operators.quantiles import exact_quantiles
from plumbline.plans.profile import fences, profile


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


# ---- quantiles ------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [40, 1_000_000])
def test_quantiles_with_hot_values(spark, limit):
    random.seed(1)
    n = 3001
    columns = {
        "plain": [random.gauss(0, 5) for _ in range(n)],
        # a third of the rows share the value at the quartile
        "hot": [7.0 if i % 3 == 0 else random.uniform(0, 10) for i in range(n)],
        "edge": [0.0] * (n // 4) + [1.0] * (n - n // 4),
        "constant": [3.5] * n,
        "infinite": [float("inf") if i % 100 == 0 else float(i) for i in range(n)],
    }
    df = frame(spark, list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    found = exact_quantiles({"t": df}, {("t", c): n for c in columns}, sorted_rows=limit)
    for c, values in columns.items():
        expected = pd.Series(values).quantile([0.25, 0.75]).tolist()
        assert found["t", c] == pytest.approx(expected, abs=1e-12), c


def test_quantiles_take_three_scans(spark, monkeypatch):
    """One sketch, one count, one selection; the rows between two proposed values are few."""
    n = 200_000
    df = spark.range(n).selectExpr("pmod(xxhash64(id), 1000000007) / 7 AS x", "CAST(id % 5 AS DOUBLE) AS y", "CAST(id AS DOUBLE) AS z")
    calls, left = [], []
    plain, chosen = quantiles.measure, quantiles._select
    monkeypatch.setattr(quantiles, "measure", lambda *a: (calls.append(1), plain(*a))[1])
    monkeypatch.setattr(quantiles, "_select", lambda t, targets, limit: (left.extend(targets), chosen(t, targets, limit))[1])
    columns = ["x", "y", "z"]
    found = exact_quantiles({"t": df}, {("t", c): n for c in columns}, sorted_rows=100)
    for c in columns:
        assert found["t", c] == pytest.approx(df.toPandas()[c].quantile([0.25, 0.75]).tolist(), rel=1e-12), c
    assert len(calls) == 2 and 0 < max(t.inside for t in left) < n * quantiles.MARGIN


def test_quantiles_count_few_at_once(spark, monkeypatch):
    """No entry holds more counts than a scan should, so that scans stay within compiled code."""
    n = 5000
    df = spark.range(n).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS y")
    entries, plain = [], quantiles.measure
    monkeypatch.setattr(quantiles, "measure", lambda tables, wanted: (entries.extend(wanted), plain(tables, wanted))[1])
    found = exact_quantiles({"t": df}, {("t", "x"): n, ("t", "y"): n}, sorted_rows=50)
    assert found == {("t", "x"): [1249.75, 3749.25], ("t", "y"): [0.0, 2.0]}
    counts = [sum(e.count("count_if(") for e in exprs.values()) for _, exprs in entries]
    assert sum(counts) > facts.AGGREGATES_PER_SCAN >= max(counts)


def test_quantiles_when_the_sketch_is_off(spark, monkeypatch):
    n = 5000
    df = spark.range(n).selectExpr("CAST(id AS DOUBLE) AS x").repartition(3)
    plain = quantiles._proposed
    wrong = [{("t", "CAST(`x` AS DOUBLE)", "CAST(`x` AS DOUBLE) IS NOT NULL"): [4000.0, 4990.0]}]
    monkeypatch.setattr(quantiles, "_proposed", lambda *a: wrong.pop() if wrong else plain(*a))
    assert exact_quantiles({"t": df}, {("t", "x"): n}, sorted_rows=50) == {("t", "x"): [1249.75, 3749.25]}


def test_quantiles_of_tiny_columns(spark):
    df = frame(spark, [(1.0, None), (None, None)], "a double, b double")
    assert exact_quantiles({"t": df}, {("t", "a"): 1, ("t", "b"): 0}) == {("t", "a"): [1.0, 1.0]}


def test_fences_round_in_sequence():
    assert fences(1.0, 3.0) == {
        "num_q1": 1.0, "num_q3": 3.0, "num_iqr": 2.0, "outlier_fence_lo": -5.0, "outlier_fence_hi": 9.0,
    }
    assert "outlier_fence_lo" not in fences(2.0, 2.0)


# ---- distinct values --------------------------------------------------------------------


def test_distinct_counts_and_samples(spark):
    long_a, long_b = "a" * 500, "a" * 499 + "b"
    rows = [(long_a, 1, 0.0), (long_a, 1, -0.0), (long_b, 2, None), (None, None, 1.5), ("z", 2, 1.5)]
    df = frame(spark, rows, "s string, i int, d double")
    found = {r["column"]: r for r in distinct.distinct_counts({"t": df}).collect()}
    assert {c: (r["unique_count"], r["repeated_rows"]) for c, r in found.items()} == {
        "s": (3, 2), "i": (2, 4), "d": (2, 4),
    }
    assert distinct.smallest_texts(df, "s", 2) == [long_a, long_b]


def test_members_are_counted_in_one_grouping(spark, monkeypatch):
    """Values of all key columns are shuffled once and no lists are collected; the result is that of the lists."""
    a = frame(spark, [("x", "1", 7), ("x", "2", 7), (None, "x", 7), ("y", "9", 7)], "`a.1` string, b string, z int")
    b = frame(spark, [("x", "q"), ("", "9"), ("", None)], "c string, d string")
    listed = [(3, "t", "a.1"), (1, "t", "b"), (0, "u", "d"), (2, "u", "c")]
    keys = spark.createDataFrame(listed, "key int, table string, column string")
    plans = []
    monkeypatch.setattr(relate, "cut", lambda df: (plans.append(df._jdf.queryExecution().sparkPlan().toString()), df)[1])
    wanted = {"t": ["a.1", "b"], "u": ["d", "c"]}
    found = relate.group_values({"t": a, "u": b}, keys)
    expected = relate.value_members(distinct.value_counts({"t": a, "u": b}, wanted), keys)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select("value", "members", "keys").collect()))
    assert found.columns == expected.columns and len(plans) == 1 and "collect_list" not in plans[0]
    monkeypatch.setattr(relate, "COUNTED_KEYS", 3)
    assert sorted(map(str, relate.group_values({"t": a, "u": b}, keys).collect())) == sorted(map(str, found.collect()))


def test_numbers_are_bounded_apart_from_text(spark, monkeypatch):
    """Aggregates of text are not compiled, so no scan holds both."""
    df = spark.range(100).selectExpr("id", "CAST(id % 7 AS STRING) AS s", "id / 3 AS d", "CAST(id AS STRING) AS t")
    calls, plain = [], distinct.measure
    monkeypatch.setattr(distinct, "measure", lambda tables, wanted: (calls.append(wanted), plain(tables, wanted))[1])
    got = {}
    for r in distinct.smallest_values({"t": df}, k=2).orderBy("column", "rank").collect():
        got.setdefault(r["column"], []).append(r["value"])
    assert got == {"id": ["0", "1"], "s": ["0", "1"], "d": ["0.0", "0.3333333333333333"], "t": ["0", "1"]}
    texts = [{"`s`" in str(e) or "`t`" in str(e) for _, e in wanted} for wanted in calls if wanted]
    assert texts == [{False}, {True}]


def test_smallest_texts_skips_hot_values(spark):
    df = frame(spark, [("b",)] * 90 + [("a",)] * 90 + [("c",), ("d",)], "s string")
    assert distinct.smallest_texts(df, "s", 5) == ["a", "b", "c", "d"]
    assert distinct.smallest_texts(df, "s", 3) == ["a", "b", "c"]


def test_top_values_break_ties_by_value(spark):
    df = frame(spark, [(v,) for v in "ccbbaadxyz"], "v string")
    top = distinct.top_values(distinct.value_counts({"t": df}, {"t": ["v"]}), 4).orderBy("rank")
    assert [(r["value"], r["n"]) for r in top.collect()] == [("a", 2), ("b", 2), ("c", 2), ("d", 1)]


@pytest.mark.parametrize("counters,looked_into", [(1 << 16, 64), (16, 4), (2, 1), (1, 1)])
def test_heavy_values(spark, monkeypatch, counters, looked_into):
    """Exact whether the first counters prove it or all values are grouped."""
    rng = random.Random(4)
    rows = [
        (rng.choice(["hot", "warm"]) if k % 3 else f"v{rng.randint(0, 500)}", f"id{k}", float(rng.randint(0, 3)),
         rng.choice([None, "x" * 5000, "y" * 5000]), None)
        for k in range(3000)
    ]
    names = ["a", "unique", "d", "long", "none"]
    df = frame(spark, rows, "a string, unique string, d double, long string, none string")
    found = distinct.heavy_values({"t": df, "u": df}, {"t": names, "u": ["a"]}, 5, counters, looked_into)
    got = {}
    for r in found.collect():
        got.setdefault((r["table"], r["column"]), []).append((r["rank"], r["value"], r["n"]))
    for place, name in enumerate(names):
        counts = Counter(str(r[place]) for r in rows if r[place] is not None)
        top = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:5]
        assert sorted(got.pop(("t", name), [])) == [(i, v, n) for i, (v, n) in enumerate(top, 1)]
    assert set(got) == {("u", "a")}


def test_heavy_values_do_not_group_every_text(spark, monkeypatch):
    """Ten texts stand out of thousands: only those of the largest counters are grouped."""
    rows = [(f"rare text {k} " * 50,) for k in range(4000)] + [(f"hot text {k} " * 50,) for k in range(10)] * 40
    df = frame(spark, rows, "s string")
    grouped = []
    plain = distinct.cells
    monkeypatch.setattr(distinct, "cells", lambda *args: (grouped.append(args[0]), plain(*args))[1])
    found = distinct.heavy_values({"t": df}, {"t": ["s"]}, 10).collect()
    assert [r["n"] for r in found] == [40] * 10 and all(r["value"].startswith("hot") for r in found)
    assert len(grouped) == len(distinct.SLOTS)  # no second look at all values


@pytest.mark.parametrize("rows", [[5, 4, 3, 2, 1] * 40, list(range(3000, 0, -1)), [7] * 50, [], [None, 3, None, 1]])
def test_smallest_values_take_two_scans(spark, rows):
    """Falling order, few values and none: the bound holds, and values above it are not grouped."""
    df = spark.createDataFrame([(v, None if v is None else f"{v:05d}", None if v is None else v / 2) for v in rows],
                               "i int, s string, d double").coalesce(1)
    found = {}
    for r in distinct.smallest_values({"t": df}, k=5).collect():
        found.setdefault(r["column"], []).append((r["rank"], r["value"]))
    least = sorted({v for v in rows if v is not None})[:5]
    for column, show in (("i", str), ("s", lambda v: f"{v:05d}"), ("d", lambda v: str(v / 2))):
        assert sorted(found.get(column, [])) == [(i, show(v)) for i, v in enumerate(least, 1)]
    if len(set(rows)) > 100:
        bound = distinct._bounds({"t": df}, {"t": ["i"]}, 5)["t", "i"]
        assert 5 <= int(bound) < 100


def test_days_come_from_bitmaps(spark):
    rng = random.Random(3)
    days = ["0001-01-01", "1582-10-15", "1969-12-31", "1970-01-01", "9999-12-31", None]
    days += [str(datetime(1900, 1, 1) + timedelta(days=rng.randint(0, 70_000)))[:10] for _ in range(3000)] * 2
    df = frame(spark, [(d, d and f"{d} 23:59:59") for d in days], "a string, b string").selectExpr(
        "CAST(a AS DATE) AS a", "CAST(b AS TIMESTAMP_NTZ) AS b"
    )
    found = temporal._days({"t": df, "u": df.limit(0)}, [("t", "a"), ("t", "b"), ("u", "a")])
    got = sorted((r["series"], str(r["day"])) for r in found.selectExpr("series", "CAST(day AS STRING) AS day").collect())
    assert got == sorted((s, d) for s in (0, 1) for d in {d for d in days if d})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan and "Distinct" not in plan


def test_years_of_any_length_are_in_order():
    moments = ["-0005-01-01 00:00:00", "0099-05-01 00:00:00", "2024-01-01 00:00:00", "+10000-01-01 00:00:00"]
    assert sorted(moments[::-1], key=distinct._year_first) == moments


def test_rank_filters_limit_inside_the_task(spark):
    df = frame(spark, [(v,) for v in "aabbc"], "v string")
    top = distinct.top_values(distinct.value_counts({"t": df}, {"t": ["v"]}), 2)
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


# ---- types and keys ---------------------------------------------------------------------


def type_of(spark, values):
    df = frame(spark, [(v,) for v in values], "v string")
    return infer.infer_types({"t": df}).first()["inferred_type"]


def test_type_thresholds(spark):
    words = [f"word {i}" for i in range(100)]
    assert type_of(spark, ["2024-01-01"] * 71 + words[:29]) == "date"
    assert type_of(spark, ["2024-01-01"] * 70 + words[:30]) != "date"
    # dates that match the pattern but do not parse
    assert type_of(spark, ["2024-13-45"] * 80 + words[:20]) == "categorical"
    assert type_of(spark, [str(i) for i in range(86)] + words[:14]) == "numeric"
    assert type_of(spark, [str(i) for i in range(85)] + words[:15]) == "text"
    assert type_of(spark, [f"AB-{i:04d}" for i in range(61)] + words[:39]) == "id"
    assert type_of(spark, [f"AB-{i:04d}" for i in range(60)] + words[:40]) == "text"
    assert type_of(spark, words[:30]) == "categorical"
    assert type_of(spark, words[:31]) == "text"
    assert type_of(spark, words[:31] * 4) == "categorical"
    assert type_of(spark, [None, None]) == "text"


def test_primary_key_rules(spark):
    rows = [(i, f"K-{i}", "x", i if i else 1) for i in range(200)]
    df = frame(spark, rows, "n int, code string, kind string, almost int")
    found = profile({"t": df, "tiny": df.limit(4)}, stages=("distinct",))
    assert [t["likely_pk"] for t in found.table_rows] == ["code", None]
    flags = {r["column"]: (r["is_likely_pk"], r["is_likely_fk"]) for r in found.rows if r["table"] == "t"}
    assert flags == {"n": (False, False), "code": (True, False), "kind": (False, False), "almost": (False, False)}
    declared = profile({"t": df}, declared_keys={"t": "almost"}, stages=("distinct",))
    assert declared.table_rows[0]["likely_pk"] == "almost"
    assert declared.table_rows[0]["duplicate_pk_rows"] == 2


def test_cardinality_needs_fifteen_rows(spark):
    few = frame(spark, [("v",)] * 14, "v string")
    one = frame(spark, [("v",)] * 15, "v string")
    many = frame(spark, [(f"w {i}",) for i in range(25)], "v string")
    rows = profile({"few": few, "one": one, "many": many}, stages=()).rows
    assert [r["cardinality_flag"] for r in rows] == ["OK", "LOW", "HIGH"]


# ---- relationships ----------------------------------------------------------------------


def brute_relationships(tables, columns):
    """The pairwise rules on value sets, for tiny tables."""
    found = {}
    names = list(tables)
    info = {(r["table"], r["column"]): r for r in columns}

    def tokens(s):
        return set(s.lower().replace("_", "-").replace(" ", "-").split("-"))

    for t1 in names:
        for t2 in names:
            for (ta, a), ra in info.items():
                for (tb, b), rb in info.items():
                    if (ta, tb) != (t1, t2) or t1 == t2 or ra["inferred_type"] != rb["inferred_type"]:
                        continue
                    if ra["inferred_type"] not in ("id", "categorical"):
                        continue
                    va, vb = set(tables[t1][a].dropna()), set(tables[t2][b].dropna())
                    name = len(tokens(a) & tokens(b)) / len(tokens(a) | tokens(b))
                    shared = len(va & vb)
                    share = shared / len(va) * 100
                    if share < 5 or (share < 20 and name < 0.5):
                        continue
                    source, target, own = (t1, a), (t2, b), va
                    if ra["unique_pct"] > rb["unique_pct"]:
                        source, target, own = (t2, b), (t1, a), vb
                    share = shared / len(own) * 100
                    if (source, target) in found:
                        continue
                    level = "LOW"
                    if share >= 50 or name >= 0.7:
                        level = "MEDIUM"
                    if (share >= 80 and name >= 0.7) or share >= 95:
                        level = "HIGH"
                    found[source, target] = (level, round(share, 1))
    return found


def test_relationships_match_pairwise_rules(spark):
    random.seed(5)
    pandas_tables = {}
    for t in range(4):
        size = random.choice([20, 40, 60])
        pandas_tables[f"t{t}"] = pd.DataFrame({
            "item-code": [f"IT-{random.randint(1000, 1030 + 20 * t)}" for _ in range(size)],
            f"code_{t}": [f"IT-{random.randint(1020, 1060)}" for _ in range(size)],
            # one value holds a third of the rows
            "colour": ["red" if i % 3 == 0 else random.choice("abcdef") for i in range(size)],
            "shade": [random.choice(["red", "a", "x", "y", None]) for _ in range(size)],
        })
    tables = {n: spark.createDataFrame(p.where(p.notna(), None)).repartition(3) for n, p in pandas_tables.items()}
    found = profile(tables, stages=())
    expected = brute_relationships(pandas_tables, found.rows)
    got = {
        ((r["from_table"], r["from_column"]), (r["to_table"], r["to_column"])): (r["confidence"], r["match_pct"])
        for r in found.relationships.collect()
    }
    assert got == expected
    # orphans by sets
    for r in found.relationships.collect():
        own = pandas_tables[r["from_table"]][r["from_column"]].dropna()
        other = set(pandas_tables[r["to_table"]][r["to_column"]].dropna())
        missing = own[~own.isin(other)]
        assert (r["orphan_rows"], r["orphan_values"]) == (len(missing), missing.nunique())
    examples = relate.orphan_examples(found.value_members, found.relationships).collect()
    keys = {(r["from_key"], r["to_key"]): r for r in found.relationships.collect()}
    for e in examples:
        r = keys[e["from_key"], e["to_key"]]
        own = pandas_tables[r["from_table"]][r["from_column"]].dropna()
        other = set(pandas_tables[r["to_table"]][r["to_column"]].dropna())
        assert e["examples"] == sorted(set(own) - other)[:5]


# ---- duplicates -------------------------------------------------------------------------


def test_duplicate_rows_with_nulls_and_hot_copies(spark):
    rows = [(None, "a", 1.0)] * 2 + [("a", None, 1.0)] + [("x", "y", 2.0)] * 30 + [
        (str(i), "z", None) for i in range(40)
    ]
    df = frame(spark, rows, "a string, b string, c double")
    assert duplicates.duplicate_row_count(df).first()[0] == 1 + 29
    assert duplicates.duplicate_row_count(df.where("a = '1'")).first()[0] == 0


def test_duplicate_rows_with_nested_columns(spark):
    rows = [([1, 2], {"k": 1, "l": 2}), ([1, 2], {"l": 2, "k": 1}), ([2, 1], {"k": 1, "l": 2})]
    df = frame(spark, rows, "a array<int>, m map<string,int>")
    assert duplicates.duplicate_row_count(df).first()[0] == 1


def test_keep_latest_and_flags(spark):
    rows = [("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z"), (None, 3, "n"), (None, 4, "m")]
    df = frame(spark, rows, "k string, v int, w string")
    kept = {tuple(r) for r in duplicates.keep_latest(df, ["k"], ["v"]).collect()}
    assert kept == {("A", 2, "y"), ("B", 1, "z"), (None, 4, "m")}
    flagged = {
        (r["k"], r["v"]): (r["is-duplicate"], r["version-flag"])
        for r in duplicates.flag_duplicates(df, ["k"], "v").collect()
    }
    assert flagged == {
        ("A", 1): (True, "OLDER"), ("A", 2): (True, "LATEST"), ("B", 1): (False, "LATEST"),
        (None, 3): (True, "OLDER"), (None, 4): (True, "LATEST"),
    }


# ---- dates ------------------------------------------------------------------------------


def brute_gaps(values):
    valid = pd.Series(sorted(values))
    if len(valid) <= 5:
        return 0
    steps = valid.diff().dropna()
    median = steps.median()
    if not median > pd.Timedelta(0):
        return 0
    if median <= pd.Timedelta(days=2):
        days = valid.values.astype("datetime64[D]")
        return int((np.busday_count(days[:-1], days[1:]) > 1).sum())
    return int((steps > median * 3).sum())


def series_cases():
    monday = datetime(2024, 1, 1)
    weekdays = [monday + timedelta(d) for d in range(60) if (monday + timedelta(d)).weekday() < 5]
    random.seed(3)
    return {
        "weekdays": weekdays,
        "holes": [d for i, d in enumerate(weekdays) if i % 7 != 3],
        "repeated": [d for d in weekdays for _ in range(3)],
        "few_repeats": weekdays + weekdays[:10],
        "monthly": [datetime(2020 + i // 12, i % 12 + 1, 1) for i in range(30) if i not in (5, 6, 7, 8, 20)],
        "monthly_repeats": [datetime(2020 + i // 12, i % 12 + 1, 1) for i in range(30) if i not in (5, 6, 7, 8)] * 2,
        "sparse_repeats": [datetime(2020, 1, 1) + timedelta(5 * i + (40 if i > 6 else 0)) for i in range(14)]
        + [datetime(2020, 1, 1)] * 3,
        "two_days": [monday + timedelta(2 * i) for i in range(20)],
        "hours": [monday + timedelta(hours=random.randint(0, 24 * 30)) for _ in range(300)],
        "short": weekdays[:5],
        "even": [monday + timedelta(d) for d in (0, 1, 2, 10, 20, 30, 60)],
    }


def test_date_gaps_match_the_ordered_series(spark):
    cases = series_cases()
    tables = {n: frame(spark, [(v,) for v in vs] + [(None,)], "d timestamp_ntz") for n, vs in cases.items()}
    known = temporal.distinct_moments(tables, [(n, "d") for n in cases])
    found = temporal.date_gaps(tables, known)
    assert {n: found[n, "d"] for n in cases} == {n: brute_gaps(vs) for n, vs in cases.items()}


def test_friday_to_monday_is_no_gap(spark):
    days = [datetime(2024, 1, d) for d in (1, 2, 3, 4, 5, 8, 9, 10, 11, 12, 15)]
    assert brute_gaps(days) == 0
    df = frame(spark, [(d,) for d in days], "d timestamp_ntz")
    assert temporal.business_day_gaps({"t": df}, [("t", "d")]) == {("t", "d"): 0}


# ---- ordered operators ------------------------------------------------------------------


def brute_fill(rows):
    last, out = None, {}
    for day, key, value in sorted(rows, key=lambda r: (r[0] is None, r[0] or datetime.min, r[1])):
        last = value if value is not None else last
        out[key] = last
    return out


@pytest.mark.parametrize("buckets", [1, 7])
def test_forward_fill_with_a_hot_date(spark, buckets):
    random.seed(11)
    start = datetime(2024, 1, 1)
    rows = []
    for key in range(600):
        day = start + timedelta(5) if key % 3 == 0 else start + timedelta(random.randint(0, 300))
        rows.append((None if key % 97 == 0 else day, key, None if random.random() < 0.7 else float(key)))
    df = frame(spark, rows, "day timestamp_ntz, key int, value double")
    found = ordered.forward_fill(df, "day", ["value"], buckets=buckets)
    assert {r["key"]: r["value"] for r in found.collect()} == brute_fill(rows)


def test_forward_fill_crosses_empty_buckets(spark):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(i), i, 1.5 if i == 3 else None) for i in range(200)]
    df = frame(spark, rows, "day timestamp_ntz, key int, value double")
    found = ordered.forward_fill(df, "day", ["value"], buckets=8)
    assert {r["key"]: r["value"] for r in found.collect()} == {i: None if i < 3 else 1.5 for i in range(200)}


def test_buckets_split_identical_rows(spark):
    df = frame(spark, [(datetime(2024, 1, 1), 1)] * 4000, "day timestamp_ntz, v int")
    sizes = ordered.bucketed(df, [F.col("day"), F.col("v")], 4).groupBy(ordered.BUCKET).count()
    assert max(r["count"] for r in sizes.collect()) < 2500


def test_asof_join_uses_dates_not_values(spark):
    rates = frame(spark, [("2021-06-01", 1.218), ("2022-05-31", None), ("2022-06-30", 1.0484)], "d string, r double")
    rates = rates.select(F.col("d").cast("date").alias("d"), "r")
    left = frame(spark, [("2021-01-01", 1), ("2021-06-01", 2), ("2022-06-01", 3), ("2022-07-15", 4), (None, 5)], "x string, i int")
    left = left.select(F.col("x").cast("date").alias("x"), "i")
    found = ordered.asof_join(left, "x", rates, "d", ["r"], buckets=3)
    assert {r["i"]: r["r"] for r in found.collect()} == {1: None, 2: 1.218, 3: None, 4: 1.0484, 5: None}


# ---- remediation ------------------------------------------------------------------------


def test_flags_treat_missing_as_ok(spark):
    df = frame(spark, [(1.0, "1"), (99.0, "99"), (None, "N/A")], "a double, b string")
    flagged = remediate.flag_outliers(df, {"a": (0, 10), "b": (0, 10)}).collect()
    assert {(r["a"], r["a-quality-flag"], r["b-quality-flag"]) for r in flagged} == {
        (1.0, "OK", "OK"), (99.0, "OUTLIER", "OUTLIER"), (None, "OK", "OK"),
    }


def test_mapped_rows_are_not_multiplied(spark):
    rows = frame(spark, [("a", 1), ("b", 2), (None, 3)] + [("a", i) for i in range(10, 30)], "k string, i int")
    reference = frame(spark, [("a",), ("a",), ("c",), (None,)], "k string")
    marked = remediate.mark_mapped(rows, reference, ["k"])
    assert Counter(r["is-mapped"] for r in marked.collect()) == {True: 21, False: 2}
    mapped, unmapped = remediate.split_mapped(rows, reference, ["k"])
    assert (mapped.count(), unmapped.count()) == (21, 2)
    joined = remediate.mark_reference_data(
        rows, "k", frame(spark, [("a", 1.0), ("a", 2.0), ("c", 3.0)], "rk string, v double"), "rk", "v"
    )
    assert joined.count() == 23 and {r["v"] for r in joined.collect()} == {2.0, None}


# ---- measures ---------------------------------------------------------------------------


def book(spark, trades):
    transactions = frame(spark, trades, "`product-code` string, `transaction-quantity` double, `transaction-price` double, day string")
    transactions = transactions.withColumn("transaction-date", F.col("day").cast("date")).drop("day")
    products = frame(spark, [("A", "LN"), ("B", "EQ"), ("C", "LN")], "`product-code` string, `product-type` string")
    return transactions, products


def test_exposure_is_null_when_positions_cancel(spark):
    transactions, products = book(spark, [
        ("A", 3_900_000.0, 1.1, "2022-06-29"), ("A", -3_900_000.0, 1.1, "2022-06-29"), ("B", 5.0, 1.0, "2022-06-30"),
    ])
    assert measures.loan_exposure(transactions, products).first()[0] is None
    transactions, products = book(spark, [("A", 10.0, 1.25, "2022-06-29"), ("C", -2.0, 1.0, "2022-06-29"), ("B", 9.0, 9.0, "2022-06-30")])
    assert measures.loan_exposure(transactions, products).first()[0] == 10.5


def test_portfolio_value_takes_the_latest_date_not_the_highest_value(spark):
    transactions, _ = book(spark, [("A", 1.0, 1.0, "2022-07-01")])
    prices = frame(spark, [("2022-05-31", 10.96, 7.0), ("2022-06-30", 6.63, 7.16), ("2022-07-31", 99.0, 99.0)],
                   "d string, `P1-EUR` double, `P2-USD` double")
    prices = prices.withColumn("price-date", F.col("d").cast("date")).drop("d")
    fx = frame(spark, [("2021-06-01", 1.218), ("2022-06-30", 1.0484), ("2022-07-02", 2.0)], "d string, EURUSD double")
    fx = fx.withColumn("price-date", F.col("d").cast("date")).drop("d")
    assert measures.portfolio_value(transactions, prices, fx).first()[0] == pytest.approx(6.63 * 1.0484 + 7.16)


def test_average_ltv_leaves_outliers_out(spark):
    products = frame(spark, [("LN", 2.0), ("LN", 4.0), ("LN", 33.33), ("EQ", 1.0), ("LN", None)],
                     "`product-type` string, `loan-property-value-ratio` double")
    row = measures.average_ltv(products, 0.0, 10.0).first()
    assert (row["avg_ltv"], row["avg_ltv_pct"]) == (0.375, 37.5)


# ---- drift ------------------------------------------------------------------------------


def test_schema_drift_order_and_names(spark):
    actual = {
        "FX_V2".lower(): ["price-date", "EURUSD", "zeta", "alpha"], "prices_v3": ["price-date", "P1-EUR"],
        "transactions": drift.K.EXPECTED_SCHEMA["transactions"], "portfolios": drift.K.EXPECTED_SCHEMA["portfolios"],
        "unknown": ["x"],
    }
    events = [(e["type"], e["table"], e["column"]) for e in drift.schema_drift(spark, actual).collect()]
    assert events == [
        ("TABLE_MISSING", "products", None), ("COLUMN_MISSING", "prices", "P2-USD"),
        ("COLUMN_ADDED", "fx", "alpha"), ("COLUMN_ADDED", "fx", "zeta"),
    ]


def test_facts_split_wide_tables(spark):
    width = 40
    df = frame(spark, [tuple(float(i * j) for j in range(width)) for i in range(10)],
               ", ".join(f"`c.{j}-x` double" for j in range(width)))
    found = {r["column"]: r for r in facts.column_facts({"t": df}).collect()}
    assert len(found) == width
    assert found["c.39-x"]["num_max"] == 9.0 * 39 and found["c.39-x"]["null_count"] == 0


def test_samples_are_exact_whatever_rows_come_first(spark):
    random.seed(2)
    n = 3000
    rows = [
        (
            n - i, float(i % 3), random.choice(["é", "z", "Ω", "a", "A", "b", None]),
            datetime(2024, 1, 1) + timedelta(hours=n - i), i % 2 == 0, f"w{n - i:05d}",
            None if i < 2000 else i,
        )
        for i in range(n)
    ]
    schema = "i int, d double, s string, t timestamp_ntz, b boolean, w string, late int"
    df = spark.createDataFrame(rows, schema).withColumn("day", F.col("t").cast("date"))
    df = df.withColumn("m", F.col("i").cast("decimal(9,2)")).withColumn("f", F.col("d").cast("float"))
    found = {}
    for r in distinct.smallest_values({"t": df.coalesce(1)}, k=5).collect():
        found.setdefault(r["column"], []).append((r["rank"], r["value"]))
    got = {c: [v for _, v in sorted(vs)] for c, vs in found.items()}
    assert got["i"] == ["1", "2", "3", "4", "5"]
    assert got["d"] == ["0.0", "1.0", "2.0"] == got["f"]
    assert got["s"] == sorted({r[2] for r in rows if r[2]}, key=lambda v: v.encode())[:5]
    assert got["w"] == [f"w{i:05d}" for i in range(1, 6)]
    assert got["b"] == ["false", "true"]
    assert got["late"] == ["2000", "2001", "2002", "2003", "2004"]
    assert got["t"][0] == "2024-01-01 01:00:00" and got["day"][0] == "2024-01-01 00:00:00"
    assert len(got["m"]) == 5
