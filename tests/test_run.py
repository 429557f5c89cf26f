"""The whole run on small tables: sources, order of findings, invariance, outputs."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline import export, load_tables, run_quality
from plumbline.operators import drift, rules
from plumbline.plans import results
from plumbline.sources import catalog, sinks, snapshots

CONFIG = {
    "business_rules": [
        {"id": "R1", "applies_to": "trades", "validator": "allowed_values", "column": "side", "values": ["B", "S"]},
        {"id": "R2", "applies_to": "trades", "validator": "column_exists", "column": "desk"},
        {"id": "R3", "applies_to": "nowhere", "validator": "column_exists", "column": "desk"},
        {"id": "R4", "applies_to": "trades", "column": "side"},
    ]
}


def make(spark, parts=2):
    trades = [
        (f"TR-{i:05d}", f"CU-{(i % 12):04d}", "X" if i == 7 else "BS"[i % 2],
         None if i % 9 == 0 else float(i % 20) * (100 if i == 33 else 1) - (5 if i == 3 else 0),
         f"{(i % 28) + 1:02d}/0{i // 28 + 1}/2024")
        for i in range(60)
    ]
    customers = [(f"CU-{i:04d}", "EUR" if i % 2 else "USD") for i in range(10)]
    return {
        "trades": spark.createDataFrame(
            trades, "`trade-code` string, `customer-code` string, side string, `unit-price` double, `trade-date` string"
        ).repartition(parts),
        "customers": spark.createDataFrame(customers, "`customer-code` string, currency string").repartition(parts),
    }


@pytest.fixture(scope="module")
def run(spark):
    return run_quality(make(spark), CONFIG, as_of="2024-02-15")


def test_findings(run):
    found = [(r["check_id"], r["table"], r["column"], r["affected"]) for r in run.findings.collect()]
    assert found == [
        ("CHK-13", "trades", "customer-code", 10),
        ("CHK-09", "trades", "desk", 60),
        ("CHK-12", "trades", "unit-price", 1),
        ("CHK-D2", "trades", "trade-date", 17),
        ("CHK-03", "trades", "unit-price", 7),
        ("CHK-11", "trades", "unit-price", 1),
        ("CHK-08", "trades", "side", 1),
    ]


def test_snippets_hold_the_rows_behind_a_finding(run):
    rows = {r["check_id"]: r for r in run.findings.collect()}
    orphans = rows["CHK-13"]
    assert orphans["examples"] == ["CU-0010", "CU-0011"]
    assert len(orphans["snippet_rows"]) == 5
    assert orphans["snippet_rows"][0]["customer-code"] == "CU-0010"
    assert orphans["snippet_rows"][0]["__flag__"] == "ORPHANED"
    assert rows["CHK-12"]["snippet_rows"][0]["trade-code"] == "TR-00003"
    assert rows["CHK-08"]["snippet_rows"][0]["side"] == "X"
    assert rows["CHK-03"]["stats"]["Null count"] == "7"


def test_results_do_not_depend_on_the_partitioning(spark, run):
    other = run_quality(make(spark, parts=7), CONFIG, as_of="2024-02-15")
    assert other.findings.collect() == run.findings.collect()
    assert other.column_profile.collect() == run.column_profile.collect()
    assert other.relationships.collect() == run.relationships.collect()


def test_derived_tables(run):
    tasks = run.suggestions.collect()
    assert [t["priority"] for t in tasks] == sorted(t["priority"] for t in tasks)
    assert tasks[0]["id"] == "S-001"
    assert run.checklist.count() == run.issues.count()
    states = {r["check_id"]: r["status"] for r in run.inventory.collect()}
    assert states["CHK-12"] == "high" and states["CHK-04"] == "clean"
    counts = results.severity_counts(run.findings, run.drift).first()
    assert (counts["high"], counts["medium"], counts["low"], counts["observations"]) == (2, 2, 3, 0)
    assert results.to_remediate(run.findings).count() == counts["to_remediate"] == 4
    notes = {(r["table"], r["column"]): r["notes"] for r in run.data_dictionary.collect()}
    assert notes["trades", "trade-code"] == "inferred PK; high cardinality"
    assert notes["trades", "customer-code"] == "inferred FK"


def test_cleaned_tables_are_filled_and_flagged(run):
    cleaned = run.cleaned["trades"]
    assert cleaned.columns[-1] == "unit-price-quality-flag"
    assert cleaned.where(F.col("`unit-price-quality-flag`") == "OUTLIER").count() == 1
    # the first trade by date has no price and nothing before it
    assert [r["trade-code"] for r in cleaned.where("`unit-price` IS NULL").collect()] == ["TR-00000"]
    assert cleaned.count() == 60


def test_csv_source(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("﻿ code ;price; flag;day\nA-1;1.5;true;04/03/2022\nB-2;N/A;false;soon\nC-3;;true;2022-03-05\n")
    config = {"sources": {
        "t": {"file": str(path), "type": "csv", "delimiter": ";", "date_columns": ["day", "absent"]},
        "gone": {"file": str(tmp_path / "gone.csv"), "type": "csv"},
        "odd": {"file": str(path), "type": "odd"},
    }}
    loaded = load_tables(spark, config)
    assert list(loaded) == ["t"]
    df = loaded["t"]
    assert dict(df.dtypes) == {"code": "string", "price": "double", "flag": "boolean", "day": "timestamp_ntz"}
    assert [r["price"] for r in df.orderBy("code").collect()] == [1.5, None, None]
    assert [str(r["day"])[:10] for r in df.orderBy("code").collect()] == ["2022-03-04", "None", "2022-03-05"]
    with pytest.raises(catalog.NoTables):
        load_tables(spark, {"sources": {"gone": {"file": str(tmp_path / "gone.csv"), "type": "csv"}}})


def test_sinks(spark, run, tmp_path):
    sources = {"trades": {"type": "csv", "file": "x/trades.csv", "delimiter": ";"}, "absent": {"type": "csv", "file": "y"}}
    paths = sinks.write_cleaned(run.cleaned, sources, str(tmp_path))
    back = catalog.read_csv(spark, paths[0], ";")
    assert back.columns == run.cleaned["trades"].columns and back.count() == 60
    sinks.write_results(run.findings, str(tmp_path / "results"))
    lines = [json.loads(line) for f in (tmp_path / "results").glob("*.json") for line in f.read_text().splitlines()]
    assert len(lines) == run.findings.count()
    sinks.write_table(run.data_dictionary, str(tmp_path / "dictionary"))
    assert spark.read.parquet(str(tmp_path / "dictionary")).count() == 7


def test_snapshots(spark, run, tmp_path):
    path = str(tmp_path / "runs")
    assert snapshots.latest(spark, path).count() == 0
    for number in (1, 2):
        rows = snapshots.snapshot(run.table_profile, {"trades": "in/trades.csv"}, f"run-{number}", f"2024-01-0{number}")
        snapshots.append(rows, path)
    info = snapshots.baseline_info(snapshots.latest(spark, path)).collect()
    assert len(info) == 1
    assert info[0].asDict() == {
        "saved_at": "2024-01-02", "files": ["customers", "trades.csv"], "tables": ["customers", "trades"], "total_rows": 70,
    }


def test_a_run_broken_off_is_no_baseline(spark, run, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    rows = lambda name, at: snapshots.snapshot(run.table_profile, {}, name, at)
    snapshots.append(rows("run-9", "2024-01-02"), path, run.state.columns, run.state.values)
    missing = run.state.values.withColumn("value", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        snapshots.append(rows("run-99", "2024-01-09"), path, run.state.columns, missing)
    kept = snapshots.latest_state(spark, path)
    assert {r["run_id"] for r in kept.tables.collect()} == {"run-9"}
    assert kept.values.count() == run.state.values.count() > 0
    assert kept.columns.count() == run.column_profile.count()
    # ids are names: neither run-10 nor the time of writing decides, but the time a run was saved
    snapshots.append(rows("run-10", "2024-01-03"), path)
    snapshots.append(rows("run-8", "2024-01-01"), path)
    assert {r["run_id"] for r in snapshots.latest(spark, path).collect()} == {"run-10"}
    snapshots.append(rows("a", "2024-01-03"), path)  # of two runs saved at a time the later commit
    assert {r["run_id"] for r in snapshots.latest(spark, path).collect()} == {"a"}
    assert snapshots.latest_state(spark, path).values.count() == 0


def test_new_values_are_named_up_to_a_few(spark):
    before = {"t": spark.createDataFrame([("A", 1.0)] * 30 + [("B", 3.0)] * 30, "kind string, x double")}
    rows = [(f"N{k}", 1.4) for k in range(7)] + [("A", 1.0)] * 60 + [(None, None)] * 3 + [("B", 4.5)]
    now = {"t": spark.createDataFrame(rows, "kind string, x double")}
    states = [run_quality(t).state for t in (before, now)]
    events = [tuple(r) for r in drift.run_drift(*states).where("type <> 'ROW_COUNT_CHANGE'").collect()]
    assert events == [
        ("VALUE_SET_DRIFT", "t", "kind", "MEDIUM", "7 new value(s) in 7 row(s): N0, N1, N2, N3, N4, …"),
    ]


def test_a_single_table(spark):
    df = spark.createDataFrame([(i, "a") for i in range(3)], "id int, v string")
    found = run_quality({"t": df})
    assert [r["check_id"] for r in found.findings.collect()] == ["CHK-19"]


def test_export(spark, run, tmp_path):
    config = CONFIG | {"sources": {
        "trades": {"type": "csv", "file": "in/trades.csv"}, "customers": {"type": "parquet", "file": "in/customers"},
    }}
    paths, before = export(run, config, str(tmp_path), "run-1")
    assert before.count() == 0 and len(paths) == 17
    assert spark.read.parquet(str(tmp_path / "baseline_drift")).count() == 0
    _, before = export(run, config, str(tmp_path), "run-2")
    assert before.first()["files"] == ["customers", "trades.csv"]
    assert spark.read.parquet(str(tmp_path / "cleaned_customers")).count() == 10
    assert spark.read.parquet(str(tmp_path / "checklist")).count() == run.issues.count()
    assert spark.read.parquet(str(tmp_path / "baseline_drift")).count() == 0  # nothing has changed


def changed(spark):
    """The tables of a later run: a side and a currency more, a price beyond the range, a row less, a
    column and a table more, a column less."""
    tables = make(spark)
    trades = tables["trades"].where("`trade-code` <> 'TR-00001'").withColumn("desk", F.lit("A")).drop("trade-date")
    trades = trades.withColumn("side", F.expr("CASE WHEN `trade-code` IN ('TR-00008', 'TR-00010') THEN 'Z' ELSE side END"))
    trades = trades.withColumn("unit-price", F.expr("CASE WHEN `trade-code` = 'TR-00033' THEN 99999 ELSE `unit-price` END"))
    return {"trades_v2": trades, "customers": tables["customers"], "notes": tables["customers"].select("currency")}


def test_drift_since_the_run_before(spark, run, tmp_path):
    history = str(tmp_path / "snapshots")
    export(run, CONFIG, str(tmp_path), "run-9")
    later = run_quality(changed(spark), as_of="2024-02-15", history=history)
    events = {(r["type"], r["table"], r["column"]): (r["risk"], r["detail"]) for r in later.baseline_drift.collect()}
    assert events == {
        ("TABLE_ADDED", "notes", None): ("MEDIUM", "table added"),
        ("COLUMN_ADDED", "trades", "desk"): ("MEDIUM", "column added"),
        ("COLUMN_REMOVED", "trades", "trade-date"): ("HIGH", "column removed"),
        ("ROW_COUNT_CHANGE", "trades", None): ("LOW", "60 -> 59"),
        ("VALUE_SET_DRIFT", "trades", "side"): ("MEDIUM", "1 new value(s) in 2 row(s): Z"),
        ("NUMERIC_RANGE_DRIFT", "trades", "unit-price"): ("MEDIUM", "min -2.0 -> -2.0, max 1300.0 -> 99999.0"),
    }
    paths, _ = export(later, {}, str(tmp_path), "run-10")
    assert f"{tmp_path}/baseline_drift" in paths
    assert spark.read.parquet(f"{tmp_path}/baseline_drift").count() == len(events)
    again = run_quality(changed(spark), as_of="2024-02-15", history=history)
    assert again.baseline_drift.count() == 0  # run-10 is the baseline, not run-9
    assert run_quality(changed(spark), history=str(tmp_path / "nothing")).baseline_drift.count() == 0


def test_allowed_values_of_numbers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (None,)], "v double")
    assert [(r["value"], r["n"]) for r in rules.unknown_values(df, "v", [1, 2]).collect()] == [("2.5", 1)]


def test_range_rule_on_text_numbers(spark):
    df = spark.createDataFrame([(str(i),) for i in range(30)] + [("N/A",)], "v string")
    rule = {"id": "R", "applies_to": "t", "validator": "value_range", "column": "v", "min": 2, "max": 20}
    found = run_quality({"t": df}, {"business_rules": [rule]}).findings.where("check_id = 'X6'").collect()
    assert [r["affected"] for r in found] == [11]
