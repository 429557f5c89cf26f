"""Facts from file footers: what they tell, what is scanned, and that rows are equal either way."""

import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from plumbline.functions.columns import normalise
from plumbline.operators import footers
from plumbline.operators.facts import column_facts

FOLDER = "/root/testdata/sf0.001"
ROWS = pa.table(
    {
        "whole": pa.array([3, None, -7, 2**53 + 1], pa.int64()),
        "tiny": pa.array([1, 2, 3, None], pa.int8()),
        "part": pa.array([0.5, float("nan"), None, 9.5]),
        "day": pa.array([datetime.date(2024, 1, 1), None, datetime.date(1969, 12, 31), None]),
        "moment": pa.array([datetime.datetime(2024, 1, 1, 5), None, None, None], pa.timestamp("us")),
        "text": pa.array(["a", None, "", "z" * 300]),
        "flag": pa.array([True, None, None, False]),
        "exact": pa.array([None, 1, 2, 3], pa.decimal128(10, 2)),
        "list": pa.array([[1], None, [], [2]]),
        "empty": pa.array([None] * 4, pa.int32()),
        "odd.name `x`": pa.array([1, 2, 3, 4], pa.int32()),
    }
)


def facts_of(spark, path):
    return {r["column"]: r.asDict() for r in footers.footer_facts(spark, {"t": path}).collect()}


def compare(spark, found, path):
    full = column_facts({"t": normalise(spark.read.parquet(path))}).collect()
    assert [r["column"] for r in full] == list(found)
    for row in full:
        for name in ("position", "kind", "row_count", "null_count", "num_min", "num_max", "date_min", "date_max"):
            assert found[row["column"]][name] == row[name], (row["column"], name)


def test_equal_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    (tmp_path / "t").mkdir()
    pq.write_table(ROWS, f"{path}/a.parquet", row_group_size=2)
    pq.write_table(ROWS.slice(1, 2), f"{path}/b.parquet")
    found = facts_of(spark, path)
    compare(spark, found, path)
    told = {name for name, row in found.items() if row["from_footer"]}
    assert told == {"whole", "tiny", "day", "text", "flag", "odd.name `x`"}  # no bounds without a value


def test_files_without_statistics_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    (tmp_path / "t").mkdir()
    pq.write_table(ROWS, f"{path}/a.parquet", write_statistics=["tiny", "text"])
    pq.write_table(ROWS, f"{path}/b.parquet")
    found = facts_of(spark, path)
    compare(spark, found, path)
    assert found["tiny"]["from_footer"] and not found["whole"]["from_footer"]


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "a int, b double, c string").write.parquet(str(tmp_path / "t"))
    found = facts_of(spark, str(tmp_path / "t"))
    assert {(r["row_count"], r["null_count"], r["num_min"]) for r in found.values()} == {(0, 0, None)}


@pytest.mark.parametrize("name", ["lineitem", "orders", "documents"])
def test_no_rows_are_read(spark, name, tmp_path):
    """The plan holds the aggregates, and files whose pages are zeros are told from their footers."""
    whole = Path(f"{FOLDER}/{name}.parquet").read_bytes()
    footer = int.from_bytes(whole[-8:-4], "little") + 8
    hollow = tmp_path / "hollow.parquet"
    hollow.write_bytes(whole[:4] + bytes(len(whole) - footer - 4) + whole[-footer:])
    df = footers.footer_session(spark).read.parquet(str(hollow))
    fields = [f for f in df.schema.fields if footers._aggregates(f)]
    query = footers.asked(df, fields)
    assert footers.pushed(query)
    row, full = query.first(), spark.read.parquet(f"{FOLDER}/{name}.parquet")
    assert row["row_count"] == full.count()
    for i, f in enumerate(fields):
        assert row[f"{i}_filled"] == full.where(f"`{f.name}` IS NOT NULL").count()
    with pytest.raises(Exception):
        spark.read.parquet(str(hollow)).write.format("noop").mode("overwrite").save()
