"""Delimited files and date forms that must not lose anything."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import rules
from plumbline.plans.checks import business_rules
from plumbline.plans.profile import profile
from plumbline.sources import catalog, sinks


def load(spark, path, **more):
    source = {"type": "csv", "file": str(path), "delimiter": ";"} | more
    return catalog.load_tables(spark, {"sources": {"t": source}}, typed=False)["t"]


def test_a_quoted_line_break_stays_in_its_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x;y;z\n1;"a\nb";2\n3;"say ""no""";4\n5;;6\n')
    rows = [tuple(r) for r in load(spark, tmp_path / "a.csv").collect()]
    assert rows == [("1", "a\nb", "2"), ("3", 'say "no"', "4"), ("5", None, "6")]
    rows = [tuple(r) for r in load(spark, tmp_path / "a.csv", multiline=True).collect()]
    assert rows[0] == ("1", "a\nb", "2")


def test_surplus_fields_are_an_error(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x;y\n1;2\n3;4;5\n")
    with pytest.raises(catalog.MalformedSource, match="1 record"):
        load(spark, tmp_path / "b.csv")


def test_a_surplus_missing_token_is_an_error_too(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x;y\n1;2\n3;4;N/A\n5;6;\n")
    with pytest.raises(catalog.MalformedSource, match="source 't'.*1 record"):
        load(spark, tmp_path / "b.csv")


def test_one_scan_settles_a_delimited_file(spark, tmp_path, monkeypatch):
    """Surplus fields, date forms, lost dates and types come from one aggregate."""
    (tmp_path / "a.csv").write_text(
        "id;price;flag;day;us;note\n1;1.5;true;04/03/2022;12/25/2022;x\n2;N/A;false;soon;01/02/2022;\n3;;true;2022-03-05;;7\n"
    )
    scans, plain = [], type(spark.range(1)).agg
    monkeypatch.setattr(type(spark.range(1)), "agg", lambda self, *a: (scans.append(1), plain(self, *a))[1])
    source = {"type": "csv", "file": str(tmp_path / "a.csv"), "delimiter": ";", "multiline": False,
              "date_columns": ["day", "us", "absent"]}
    df = catalog.load_tables(spark, {"sources": {"t": source}})["t"]
    assert len(scans) == 1
    assert dict(df.dtypes) == {"id": "bigint", "price": "double", "flag": "boolean", "day": "timestamp_ntz",
                               "us": "timestamp_ntz", "note": "string"}
    rows = [(r["id"], r["price"], str(r["day"])[:10], str(r["us"])[:10], r["note"]) for r in df.orderBy("id").collect()]
    assert rows == [(1, 1.5, "2022-03-04", "2022-12-25", "x"), (2, None, "None", "2022-01-02", None), (3, None, "2022-03-05", "None", "7")]


def test_a_source_that_fails_is_named_or_skipped(spark, tmp_path, caplog):
    (tmp_path / "good.csv").write_text("x,y\n1,2\n")
    (tmp_path / "bad.csv").write_text("x,y\n1,2,3\n")
    (tmp_path / "odd.parquet").write_text("this is no parquet file")
    sources = {name: {"type": kind, "file": f"{tmp_path}/{name}.{kind}"} for name, kind in
               (("bad", "csv"), ("odd", "parquet"), ("good", "csv"))}
    with pytest.raises(catalog.MalformedSource, match="source 'bad'"):
        catalog.load_tables(spark, {"sources": sources})
    assert list(catalog.load_tables(spark, {"sources": sources}, skip_errors=True)) == ["good"]
    assert "'bad'" in caplog.text and "'odd'" in caplog.text
    with pytest.raises(catalog.NoTables):
        catalog.load_tables(spark, {"sources": {"bad": sources["bad"]}}, skip_errors=True)


def test_sources_of_a_folder(spark, tmp_path):
    (tmp_path / "My Trades-2024.csv").write_text("\ufeffa;b,c;d\n1;2;3\n")
    (tmp_path / "fx.CSV").write_text("a,b;c,d\n1,2,3\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "notes.txt").write_text("a,b\n")
    spark.range(3).write.parquet(f"{tmp_path}/Part.parquet")
    found = catalog.find_sources(spark, str(tmp_path))
    assert {name: (s["type"], s.get("delimiter")) for name, s in found.items()} == {
        "my_trades_2024": ("csv", ";"), "fx": ("csv", ","), "empty": ("csv", ","), "part": ("parquet", None),
    }
    tables = catalog.load_tables(spark, {"sources": {k: v for k, v in found.items() if k != "empty"}})
    assert tables["my_trades_2024"].columns == ["a", "b,c", "d"] and tables["part"].count() == 3


def test_missing_fields_are_null(spark, tmp_path):
    (tmp_path / "c.csv").write_text("x;y\n1;2\n3\n")
    assert [tuple(r) for r in load(spark, tmp_path / "c.csv").collect()] == [("1", "2"), ("3", None)]


def test_cleaned_files_keep_spaces_breaks_and_nested_columns(spark, tmp_path):
    df = spark.createDataFrame(
        [(" pad ", ["a", "b"], "one\ntwo"), ('q"q', None, ";"), (None, [], "\r\nx")],
        "a string, b array<string>, c string",
    )
    sinks.write_cleaned({"t": df}, {"t": {"type": "csv", "file": "t", "delimiter": ";"}}, str(tmp_path))
    rows = {tuple(r) for r in load(spark, tmp_path / "cleaned_t").collect()}
    assert rows == {(" pad ", '["a","b"]', "one\ntwo"), ('q"q', None, ";"), (None, "[]", "\r\nx")}


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("20240105", "2024-01-05"), ("05-Jan-2024", "2024-01-05"), ("5 January 2024", "2024-01-05"),
        ("05/01/24", "2024-01-05"), ("12/25/2022", "2022-12-25"), ("05/01/70", "1970-01-05"),
        ("2024-01-05 10:00:00", "2024-01-05"), ("1 sept 2023", "2023-09-01"), ("31/02/2024", None),
        ("5 Foo 2024", None), ("20241301", None),
    ],
)
def test_date_forms(spark, text, day):
    df = spark.createDataFrame([(text,), (None,)], "d string")
    found = catalog.coerce_dates(df, ["d"]).select(F.col("d").cast("date").cast("string")).collect()
    assert [r[0] for r in found] == [day, None]


def test_one_day_above_twelve_decides_the_column(spark, caplog):
    american = spark.createDataFrame([("01/02/2024",), ("12/25/2022",)], "d string")
    days = [str(r[0])[:10] for r in catalog.coerce_dates(american, ["d"]).collect()]
    assert days == ["2024-01-02", "2022-12-25"]
    mixed = spark.createDataFrame([("01/02/2024",), ("12/25/2022",), ("25/12/2022",)], "d string")
    days = [str(r[0])[:10] for r in catalog.coerce_dates(mixed, ["d"]).collect()]
    assert days == ["2024-02-01", "None", "2022-12-25"]
    assert "1 value(s) of date column 'd'" in caplog.text


def test_all_unknown_values_of_all_rules(spark):
    df = spark.createDataFrame([(f"v{k % 150}", k % 3, "x") for k in range(600)], "a string, b int, value string")
    wanted = [
        {"id": "1", "validator": "allowed_values", "applies_to": "t", "column": "a", "values": ["v1"]},
        {"id": "2", "validator": "allowed_values", "applies_to": "t", "column": "b", "values": ["0", 1]},
        {"id": "3", "validator": "allowed_values", "applies_to": "t", "column": "value", "values": ["x"]},
    ]
    found = rules.all_unknown_values({"t": df}, wanted).collect()
    assert len([r for r in found if r["rule"] == 0]) == 149
    assert [(r["value"], r["n"]) for r in found if r["rule"] == 1] == [("2", 200)]
    texts = business_rules(profile({"t": df}, "2024-01-01"), {"business_rules": wanted}).collect()
    assert texts[0]["description"].startswith("[1] [a] has 149 value(s)") and len(texts[0]["examples"]) == 5
    assert business_rules(profile({"t": df}, "2024-01-01"), {"business_rules": wanted[2:]}).collect() == []
