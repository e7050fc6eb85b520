"""Tables published as a set, broken exports set aside, and Latin letters folded by rule."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from canvass.functions.text import LATIN_BLOCKS, fold_latin, latin_folds
from canvass.sources import forms, sinks


def test_a_failing_sheet_leaves_the_old_set(spark, tmp_path):
    root = str(tmp_path)
    tables = {f"sheet{k}": spark.range(k + 1).withColumn("v", F.lit("old")) for k in range(8)}
    assert sinks.publish_set(tables, root, orders={"sheet3": ["-id"]}) == list(tables)
    assert [r["id"] for r in sinks.read_set(spark, root, "sheet3").collect()] == [3, 2, 1, 0]
    new = {n: t.withColumn("v", F.lit("new")) for n, t in tables.items()}
    bad = new | {"sheet6": new["sheet6"].withColumn("v", F.raise_error(F.lit("broken sheet")))}
    with pytest.raises(sinks.PublishError, match="sheet6"):
        sinks.publish_set(bad, root)
    for k in range(8):
        table = sinks.read_set(spark, root, f"sheet{k}")
        assert table.count() == k + 1 and {r["v"] for r in table.collect()} == {"old"}
    sinks.publish_set({n: t for n, t in new.items() if n != "sheet7"}, root)
    assert {r["v"] for r in sinks.read_set(spark, root, "sheet5").collect()} == {"new"}
    assert {r["v"] for r in sinks.read_set(spark, root, "sheet5", run=1).collect()} == {"old"}
    with pytest.raises(sinks.PublishError, match="sheet7"):
        sinks.read_set(spark, root, "sheet7")
    assert sorted(r["run"] for r in sinks.manifest(spark, root).select("run").distinct().collect()) == [1, 2]


def test_one_broken_form_among_three(spark, tmp_path):
    good, torn, lines = tmp_path / "good.json", tmp_path / "torn.json.gz", tmp_path / "lines.json"
    good.write_text('{"KEY": "a", "data": {"p1_01": 1}}\n{"KEY": "b", "data": {"p1_01": 2}}\n')
    torn.write_bytes(b"\x1f\x8b\x08\x00not a zip at all")
    lines.write_text('{"KEY": "c", "data": {"p1_01": 3}}\n{"KEY": "d", "data": {"p1_\n{"KEY": "e"}\n')
    with pytest.warns(UserWarning, match="form refused"):
        read, refused = forms.read_checked_forms(spark, [str(good), str(torn), str(lines), str(tmp_path / "missing.json")], multi_line=False)
    assert {r["key"] for r in read.collect()} == {"a", "b", "c", "e"} and forms.CORRUPT not in read.columns
    rows = {r["form"].rsplit("/", 1)[1]: r for r in refused.collect()}
    assert set(rows) == {"torn.json.gz", "lines.json", "missing.json"}
    assert rows["lines.json"]["record"].startswith('{"KEY": "d"') and rows["lines.json"]["reason"] == "malformed record"
    with pytest.raises(ValueError), pytest.warns(UserWarning):
        forms.read_checked_forms(spark, [str(torn)], multi_line=False)


def test_every_decomposable_latin_letter_is_folded(spark):
    letters = [chr(c) for a, b in LATIN_BLOCKS for c in range(a, b) if unicodedata.name(chr(c), "").startswith("LATIN ")]
    plain = {}
    for letter in letters:
        parts = unicodedata.normalize("NFKD", letter)
        base = "".join(p for p in parts if not unicodedata.combining(p))
        if base != letter and base.isascii() and base.isalpha():
            plain[letter] = base
    assert len(plain) > 500 and all(latin_folds()[x] == p for x, p in plain.items())
    df = spark.createDataFrame([(x, f"a{x}b") for x in letters], "letter string, text string")
    for r in df.select("letter", fold_latin("text").alias("out")).collect():
        assert r["out"] == f"a{latin_folds().get(r['letter'], r['letter'])}b"
