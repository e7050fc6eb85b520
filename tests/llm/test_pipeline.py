"""The pipeline against its stages, and the guard around the subpackage."""

import duckdb

import corpus_pipeline
import pytest
from canvass.llm.queries import ORACLE, QUERIES
from canvass.llm.store import documents
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = documents(spark, SF_DIR)
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    left = set(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.columns[: len(columns)] == columns
        if name != "mixing":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        now = {r.doc_id for r in docs.collect()}
        assert now <= left and docs.count() == len(now)
        left = now
    final = docs.collect()
    assert all(r.taken > 0 and r.n_chars == len(r.text) for r in final)
    run = corpus_pipeline.run(spark, SF_DIR)
    assert sorted((r.doc_id, r.text, r.taken) for r in run.collect()) == sorted((r.doc_id, r.text, r.taken) for r in final)


def test_clean_documents_stay(spark):
    """Of the documents labelled good, with text enough, few are lost before the mix."""
    labels = duckdb.sql(
        f"SELECT l.doc_id FROM '{SF_DIR}/labels.parquet' l JOIN '{SF_DIR}/documents.parquet' d USING (doc_id) "
        "WHERE quality = 1 AND length(text) > 300"
    ).fetchall()
    docs = documents(spark, SF_DIR)
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF_DIR).collect()}
    good = [i for (i,) in labels]
    assert sum(i in kept for i in good) >= 0.98 * len(good)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], ORACLE[name], SF_DIR) is None
