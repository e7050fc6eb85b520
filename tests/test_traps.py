"""One small case per semantic trap: NULLs, text comparison, ties, divisions by zero."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from canvass.functions import columns as cols
from canvass.functions.dates import appointment_time, on_or_after, overdue_label, submission_time
from canvass.functions.numbers import is_sentinel_text, number, percent, without_sentinels
from canvass.functions.quality import is_garbage
from canvass.functions.rules import category, keep_for_codes, recode
from canvass.functions.text import (
    address_text,
    block_label,
    fold_capitals,
    fold_latin,
    label_text,
    number_text,
    paste,
    squish,
    trim_all,
    truncate,
)
from canvass.operators import corrections, duplicates, outliers, summaries, textquality, visits
from canvass.plans import survey as sv


def values(df, *names):
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    return [r[0] for r in rows] if len(names) == 1 else rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


def test_text_that_is_no_number_is_null(spark):
    assert one(spark, number(F.lit("abc"))) is None
    assert one(spark, number(F.lit("12.5"))) == 12.5


def test_codes_compare_as_text(spark):
    df = spark.createDataFrame([("1",), ("1.0",), (None,), ("x",)], "c string")
    assert values(df.select(keep_for_codes("c", "c", ["1", "3"]).alias("v")), "v") == [
        "1", None, None, None,
    ]
    assert values(df.select(recode("c", {1: "SI"}).alias("v")), "v") == ["SI", "1.0", None, "x"]


def test_blacklist_keeps_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    assert set(values(corrections.drop_keys(df, "key", ["a"]), "key")) == {"b", None}
    assert values(corrections.only_keys(df, "key", ["a"]), "key") == ["a"]


def test_equal_filter_drops_null(spark):
    df = spark.createDataFrame([("d1",), ("d2",), (None,)], "day string")
    assert values(df.filter(F.col("day") != "d1"), "day") == ["d2"]


def test_null_keys_meet_only_when_asked(spark):
    left = spark.createDataFrame([(1, None), (2, "k")], "n int, k string")
    right = spark.createDataFrame([(None, "x"), ("k", "y")], "k string, v string")
    strict = corrections.left_lookup(left, right, ["k"])
    loose = corrections.left_lookup(left, right, ["k"], null_safe=True)
    assert dict(values(strict, "n", "v")) == {1: None, 2: "y"}
    assert dict(values(loose, "n", "v")) == {1: "x", 2: "y"}


def test_repeated_dictionary_keys_repeat_rows(spark):
    left = spark.createDataFrame([("k",)], "k string")
    right = spark.createDataFrame([("k", "x"), ("k", "y")], "k string, v string")
    assert corrections.left_lookup(left, right, ["k"]).count() == 2
    assert corrections.left_lookup(left, right, ["k"], dedupe=True).count() == 1
    df = spark.createDataFrame([("a", "old")], "key string, id string")
    rows = corrections.correct_by_key(df, "key", [("a", "n2"), ("a", "n1")], ["id"], dedupe=True)
    assert values(rows, "id") == ["n1"]


def test_paste_writes_na_and_merge_skips(spark):
    null = F.lit(None).cast("string")
    assert one(spark, paste(F.lit("a"), null, sep="_")) == "a_NA"
    assert one(spark, cols.merge_text([F.lit("a"), null, F.lit("b")])) == "a | b"
    assert one(spark, block_label(F.lit("manzana 12 bis"))) == "Manzana 12"
    assert one(spark, block_label(null)) == "Manzana NA"


def test_distinct_count_with_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    row = df.agg(
        summaries.distinct_count("v").alias("with_null"),
        summaries.distinct_count("v", count_null=False).alias("known"),
        summaries.distinct_count("v", approximate=True).alias("near"),
    ).collect()[0]
    assert (row["with_null"], row["known"], row["near"]) == (2, 1, 2)


def test_one_row_group_has_no_spread(spark):
    df = spark.createDataFrame([("k1", "g1", "5"), ("k2", "g2", "7"), ("k3", "g2", None)], "key string, g string, a string")
    out = outliers.flag_outliers(df, "g", ["a"], "key")
    assert dict(values(out, "key", "ex_a")) == {"k1": 0, "k2": 0, "k3": 0}
    minutes = df.withColumn("m", number("a"))
    timed = outliers.flag_durations(minutes, "g", "m", "key")
    assert set(values(timed, "alert_short")) == {0}
    assert set(values(timed, "duration_alert")) == {"Normal"}


def test_sentinel_in_raw_and_clean_test(spark):
    rows = [(f"k{i}", "g", str(10 + i % 3)) for i in range(30)] + [("s", "g", "99"), ("z", "g", None)]
    df = spark.createDataFrame(rows, "key string, g string, a string")
    raw = dict(values(outliers.flag_outliers(df, "g", ["a"], "key"), "key", "ex_a"))
    clean = dict(values(outliers.flag_outliers(df, "g", ["a"], "key", test="clean"), "key", "ex_a"))
    assert raw["s"] == 1 and raw["z"] is None and raw["k1"] == 0
    assert clean["s"] is None


def test_padded_sentinels_count(spark):
    assert one(spark, is_sentinel_text(F.lit(" 98 "))) is True
    assert one(spark, is_sentinel_text(F.lit(" 98 "), trim=False)) is False
    assert one(spark, is_sentinel_text(F.lit("-1"))) is True
    assert one(spark, is_sentinel_text(F.lit(None).cast("string"))) is False
    assert one(spark, without_sentinels(F.lit("98.0"))) is None


def test_nsnr_threshold_is_fixed_by_default(spark):
    rows = [("a", "98", "99", "-1", "98"), ("b", "98", "99", "-1", "1"), ("c", None, None, None, None)]
    df = spark.createDataFrame(rows, "key string, q1 string, q2 string, q3 string, q4 string")
    df = df.withColumn("g", F.lit("x"))
    out = outliers.flag_nsnr(df, "g", ["q1", "q2", "q3", "q4"], "key")
    assert dict(values(out, "key", "alert_nsnr")) == {"a": 1, "b": 0, "c": 0}
    assert dict(values(out, "key", "nsnr_rate")) == {"a": 100.0, "b": 75.0, "c": 0.0}


def test_latest_visit_ties_and_null_times(spark):
    rows = [("k2", "u", datetime(2026, 3, 1)), ("k1", "u", datetime(2026, 3, 1)), ("k0", "u", None), ("k9", None, None)]
    df = spark.createDataFrame(rows, "key string, unit string, ts timestamp")
    marked = visits.mark_latest(df, "unit", "ts", "key")
    assert dict(values(marked, "key", "is_final")) == {"k1": 1, "k2": 0, "k0": 0, "k9": 1}
    assert set(values(visits.latest_only(df, "unit", "ts", "key"), "key")) == {"k1", "k9"}
    numbered = visits.number_attempts(df, "unit", "ts", "key")
    assert dict(values(numbered, "key", "attempt")) == {"k1": 1, "k2": 2, "k0": 3, "k9": 1}


@pytest.mark.parametrize(
    "codes, expected",
    [
        ([4, 1, 2], ["Seguimiento normal", "Seguimiento normal", "⚠️ REVISITAR TRAS CIERRE"]),
        ([5, 1], ["Seguimiento normal", "⚠️ DOBLE CIERRE"]),
        ([2, 4, 1], None),
    ],
)
def test_closure_history(spark, codes, expected):
    rows = [(f"k{i}", "u", datetime(2026, 3, 1 + i), c) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows, "key string, unit string, ts timestamp, code int")
    out = visits.closure_history(df, "unit", "ts", "key", F.col("code").isin(1, 5)).orderBy("ts")
    assert values(out, "history_alert") == (expected or [])


def test_category_of_unknown_status(spark):
    code = F.lit(None).cast("double")
    assert one(spark, category(code, sv.CATEGORIES, sv.OTHER)) == "OTRO/ERROR"
    from canvass.plans.audit import one_hots

    row = spark.range(1).select(*[c.alias(n) for n, c in one_hots(code).items()]).collect()[0]
    assert (row["is_effective"], row["is_refusal"]) == (None, None)
    assert (row["is_not_eligible"], row["is_scheduled"]) == (0, 0)


def test_missing_names_collide_as_duplicates(spark):
    rows = [(f"k{i}", "1", None, None) for i in range(3)] + [
        ("p1", "1", "José", "Núñez "), ("p2", "1", "JOSE", "nuñez"), ("n1", None, "a", "b"), ("n2", None, "a", "b"),
    ]
    df = spark.createDataFrame(rows, "key string, status string, name string, surname string")
    identity = duplicates.identity([(F.col("status") == "1", ["name", "surname"])])
    df = df.withColumn("identity", identity)
    found = dict(values(duplicates.flag_duplicates(df, "identity", "key"), "key", "duplicate"))
    assert found == {"k0": 1, "k1": 1, "k2": 1, "p1": 1, "p2": 1, "n1": None, "n2": None}
    lifted = duplicates.lift_duplicates(
        duplicates.flag_duplicates(df, "identity", "key"), "key", ["k1"], ["duplicate"]
    )
    assert dict(values(lifted, "key", "duplicate"))["k1"] == 0


def test_single_row_without_identity_is_no_duplicate(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "key string, identity string")
    assert dict(values(duplicates.flag_duplicates(df, "identity", "key"), "key", "duplicate")) == {"a": 0, "b": 0}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("asdf", 1), ("aaaaaaaaa", 1), ("pndx", 1), ("dsfghj", 1), ("no hay agua aquí", 0),
        ("", 0), (None, 0), ("  ", 0), ("casa", 0), ("bcd", 0), ("qwer asdf zxcv", 0), ("año", 0),
        ("PNDX", 1), ("árból", 0), ("bstrct a", 1),
    ],
)
def test_garbage_rules(spark, text, expected):
    assert one(spark, is_garbage(F.lit(text).cast("string"))) == expected


def test_text_helpers(spark):
    assert one(spark, squish(F.lit(" a \t  b\n"))) == "a b"
    assert one(spark, trim_all(F.lit("  a b\r\n"))) == "a b"
    assert one(spark, fold_latin(F.lit("Straße Æon ñandú é Łódź"))) == "Strasse AEon nandu e Lodz"
    assert one(spark, fold_capitals(F.lit("áéíóúñü"))) == "AEIOUNÜ"
    assert one(spark, truncate(F.lit("x" * 46))) == "x" * 42 + "..."
    assert one(spark, truncate(F.lit("x" * 45))) == "x" * 45
    assert one(spark, label_text(F.lit(" <b>Ask</b> me "), F.lit("q1"), {"q2": "Other"})) == "Ask me"
    assert one(spark, label_text(F.lit("x"), F.lit("q2"), {"q2": "Other"})) == "Other"
    assert [one(spark, number_text(F.lit(v), 1)) for v in (12.0, 12.46, 0.0, 100.0)] == [
        "12", "12.5", "0", "100",
    ]


def test_address_keeps_fixed_words(spark):
    null = F.lit(None).cast("string")
    parts = [("", null), ("Piso", F.lit("NA")), ("Ref", F.lit(""))]
    assert one(spark, address_text(parts)) == "Piso Ref"
    assert one(spark, address_text(parts, only_if_any_part=True)) is None


def test_rates_over_nothing_are_null(spark):
    assert one(spark, percent(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, percent(F.lit(1), F.lit(800), 2)) == 0.13
    assert one(spark, percent(F.lit(1), F.lit(800), 2, half_even=True)) == 0.12


def test_times(spark):
    got = one(spark, submission_time(F.lit("Mar 5, 2026 1:02:03 AM")).cast("string"))
    assert got == "2026-03-04 22:02:03"
    assert one(spark, submission_time(F.lit("soon"))) is None
    assert one(spark, on_or_after(F.lit("2026-02-27 00:00:00").cast("timestamp"), "2026-02-27")) is True
    at = appointment_time(F.lit("Dia: 2026-03-01 Hora: 14:30"), "America/Montevideo")
    assert one(spark, at.cast("string")) == "2026-03-01 17:30:00"
    now = datetime(2026, 3, 1, 18, 0)
    assert one(spark, overdue_label(at, now)) == "⚠️ CITA VENCIDA"
    assert one(spark, overdue_label(at, datetime(2026, 3, 1, 17, 0))) == "Pendiente"
    assert one(spark, overdue_label(F.lit(None).cast("timestamp"), now)) == "Sin Cita Programada"


def test_comment_rules(spark):
    rows = [("a", "1", " Encuesta INCOMPLETA "), ("b", "2", "No quiso"), ("c", "1", "xyz"), ("d", None, "rechazó")]
    df = spark.createDataFrame(rows, "key string, status string, comment string")
    read = textquality.classify_comments(df, "comment", sv.COMMENT_RULES, sv.STATUS_LABELS, sv.NO_COMMENT_LABEL)
    assert dict(values(read, "key", "comment_code")) == {"a": 1, "b": 5, "c": None, "d": 5}
    out = textquality.comment_discrepancy(read, "status")
    alerts = {k: (m, t) for k, m, t in values(out, "key", "comment_mismatch", "comment_alert")}
    assert alerts["a"] == (0, "OK") and alerts["c"] == (0, "OK") and alerts["d"] == (None, None)
    assert alerts["b"] == (1, "⚠️ DISCREPANCIA: Marcó 2 pero escribió 'RECHAZO'")


def test_contingency_leaves_null_out(spark):
    df = spark.createDataFrame([("d1", 1), ("d1", None), (None, 1), ("d2", 0)], "day string, a int")
    out = summaries.contingency(df, "day", "a", [0, 1])
    assert {r["day"]: (r["0"], r["1"]) for r in out.collect()} == {"d1": (0, 1), "d2": (1, 0)}


def test_names():
    assert cols.snake_names(["KEY", "SubmissionDate", "instanceID", "a.b", "a b", "1x", "% ok", "año"]) == [
        "key", "submission_date", "instance_id", "a_b", "a_b_2", "x1x", "percent_ok", "ano",
    ]


def test_select_mapping_refuses_absent_source(spark):
    with pytest.raises(ValueError, match="nope"):
        cols.select_mapping(spark.range(1), [("a", "nope")])


def test_fill_numeric_handles_nan(spark):
    df = spark.createDataFrame([(float("nan"), None, "x")], "a double, b long, c string")
    assert values(cols.fill_numeric_nulls(df), "a", "b", "c") == [(0.0, 0, "x")]
