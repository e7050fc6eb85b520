"""Sources and sinks over temporary folders."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from canvass.operators import formlogic, reshape
from canvass.operators.formlogic import FormRule
from canvass.session import cut_lineage, shared_folder
from canvass.sources import forms, sinks, tables


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_forms_are_flattened_cleaned_and_stacked(spark, tmp_path):
    one = write(tmp_path / "a.json", json.dumps([
        {"KEY": "uuid:1", "geo": {"Latitude": -34.5, "deep": {"x": 1}}, "note": "", "list": [1, 2]},
        {"KEY": "uuid:2", "geo": {"Latitude": None, "deep": None}, "note": "hi", "list": None},
    ]))
    two = write(tmp_path / "b.json", json.dumps([{"KEY": "uuid:3", "extraField": 7}]))
    with pytest.warns(UserWarning, match="nothing at"):
        df = forms.read_forms(spark, [one, str(tmp_path / "absent.json"), two])
    assert set(df.columns) == {"key", "geo_latitude", "geo_deep_x", "note", "list", "extra_field"}
    assert all(t == "string" for _, t in df.dtypes)
    rows = {r["key"]: r.asDict() for r in df.collect()}
    assert rows["uuid:1"]["geo_latitude"] == "-34.5" and rows["uuid:1"]["note"] is None
    assert json.loads(rows["uuid:1"]["list"]) in ([1, 2], ["1", "2"])
    assert rows["uuid:2"]["geo_deep_x"] is None and rows["uuid:2"]["note"] == "hi"
    assert rows["uuid:3"]["extra_field"] == "7" and rows["uuid:3"]["note"] is None


def test_json_lines_with_a_schema(spark, tmp_path):
    path = write(tmp_path / "l.json", '{"KEY": "1", "n": 5}\n{"KEY": "2"}\n')
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("KEY", T.StringType()), T.StructField("n", T.LongType())])
    df = forms.read_forms(spark, [path], multi_line=False, schema=schema)
    assert {(r["key"], r["n"]) for r in df.collect()} == {("1", "5"), ("2", None)}


def test_csv_keeps_text(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,telefono_1,x\n007,099 123,NA\n8,,ok\n")
    rows = tables.read_dimension(spark, path).collect()
    assert [tuple(r) for r in rows] == [("007", "099 123", None), ("8", None, "ok")]


def test_dimension_formats(spark, tmp_path):
    df = spark.createDataFrame([("1", "u1")], "id string, users string")
    for fmt in ("parquet", "orc", "json"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert tables.read_dimension(spark, str(tmp_path / fmt), fmt).collect() == df.collect()


def test_form_rules_with_required_groups(spark):
    spec = spark.createDataFrame(
        [
            ("g1", "Group", "yes", None, None),
            ("q1", "<b>One</b>", "no", "q2 = '1'", "g1"),
            ("q2", "Two", None, None, None),
            ("q9", "Not in data", "yes", None, None),
        ],
        "variable string, label string, required string, relevant_sql string, group string",
    )
    rules = tables.form_rules(spec, ["q2", "q1"])
    assert rules == [FormRule("q2", False, None, "Two"), FormRule("q1", True, "q2 = '1'", "<b>One</b>")]
    data = spark.createDataFrame([(1, None, "1"), (2, "a", "0"), (3, None, None)], "id int, q1 string, q2 string")
    out = formlogic.flag_skips(formlogic.flag_missing(data, rules), rules)
    got = {r["id"]: (r["m_q1"], r["s_q1"], r["total_missing"], r["total_skips"]) for r in out.collect()}
    assert got == {1: (1, 0, 1, 0), 2: (0, 1, 0, 1), 3: (0, 0, 0, 0)}
    found = formlogic.findings(out, ["id"]).collect()
    assert {(r["id"], r["kind"], r["variable"]) for r in found} == {(1, "Missing", "q1"), (2, "Salto", "q1")}


def test_publish_overwrites_and_drops_nested(spark, tmp_path):
    df = spark.range(3).withColumn("geom", F.array(F.lit(1)))
    first, second = str(tmp_path / "r1"), str(tmp_path / "r2")
    sinks.publish(df, [first, second], label="report")
    sinks.publish(df.filter("id > 0"), [first, second], label="report")
    for path in (first, second):
        back = spark.read.parquet(path)
        assert back.columns == ["id"] and back.count() == 2


def test_publish_all_and_errors(spark, tmp_path):
    root = str(tmp_path / "out")
    names = sinks.publish_all(
        {"a": spark.range(2), "b": spark.range(1)}, root, also={"a": str(tmp_path / "copy")}
    )
    assert names == ["a", "b"] and spark.read.parquet(str(tmp_path / "copy")).count() == 2
    with pytest.raises(sinks.PublishError, match="broken"):
        sinks.publish(spark.range(1), str(tmp_path / "x"), label="broken", fmt="no_such_format")


def test_publish_as_table(spark):
    sinks.publish(spark.range(2), "canvass_report", label="t", as_table=True)
    try:
        assert spark.table("canvass_report").count() == 2
    finally:
        spark.sql("DROP TABLE canvass_report")


def test_published_csv_report(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(5).select((5 - F.col("id")).alias("n"))
    sinks.publish(df.coalesce(1), path, label="sorted", fmt="json", order_by=["n"])
    assert sorted(r["n"] for r in spark.read.json(path).collect()) == [1, 2, 3, 4, 5]


def test_dated_csv_writes_null_as_nothing(spark, tmp_path):
    df = spark.createDataFrame([("a", None, ""), ("b", 1, "x")], "k string, n int, t string")
    path = sinks.write_dated_csv(df.coalesce(1), str(tmp_path), date(2026, 4, 1))
    assert path.endswith("run_date=2026-04-01")
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert set(lines) == {"k,n,t", "a,,", "b,1,x"}


def test_cut_lineage_goes_on_from_the_shared_folder(spark):
    df = cut_lineage(spark.range(10).withColumn("a", F.col("id") * 2), "numbers")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) in df.inputFiles()[0] and df.count() == 10


def test_unpivot_pivot_round_trip(spark):
    df = spark.createDataFrame([("d.1", 1, 2), ("d2", 3, None)], "day string, `a.x` long, b long")
    long = reshape.to_long(df, ["day"], ["a.x", "b"], as_type="bigint")
    assert long.count() == 4
    wide = reshape.to_wide(long, ["day"], "name", "value", ["a.x", "b"])
    assert {tuple(r) for r in wide.collect()} == {tuple(r) for r in df.collect()}
    turned = reshape.transpose_summary(df, "day", ["a.x", "b"])
    assert {r["indicator"]: (r["d.1"], r["d2"]) for r in turned.collect()} == {"a.x": (1, 3), "b": (2, 0)}


def test_as_many_columns_as_there_are_days(spark):
    days = spark.range(2001).select(F.format_string("d%04d", "id").alias("day"), F.col("id").alias("n"))
    turned = reshape.transpose_summary(days, "day", ["n"])
    row = turned.collect()[0].asDict()
    assert len(row) == 2002 and row["d2000"] == 2000


def test_unlisted_values_are_not_lost(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "z"), ("b", None)]
    df = spark.createDataFrame(rows, "g string, c string")
    counted = {r["g"]: r for r in reshape.counts_to_columns(df, "g", "c", ["x", "y"], other="other").collect()}
    assert (counted["a"]["x"], counted["a"]["y"], counted["a"]["other"], counted["a"]["total"]) == (1, 1, 0, 2)
    assert (counted["b"]["x"], counted["b"]["y"], counted["b"]["other"], counted["b"]["total"]) == (0, 0, 2, 2)
    with pytest.raises(Exception, match="not among the listed"):
        reshape.to_wide(df.withColumn("v", F.lit(1)), ["g"], "c", "v", ["x", "y"]).collect()
