"""Registered queries and the pipeline on given tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tallybook.llm.queries import ORACLES, QUERIES
from tests.compare import check, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert check(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLES.get(name)) == ""


def test_pipeline_stages_on_odd_rows(spark, folder):
    """Null and empty texts, null and repeated ids, copies, clashing columns; then no rows at all."""
    prose = " ".join(f"word{k % 37} and then {k} more of it" for k in range(60))
    rows = [(1, prose), (2, prose), (2, prose), (3, None), (4, ""), (None, prose + " other ending here"), (5, " \n "), (6, "short"), (7, "x" * 30_000)]
    clash = {c: F.lit(c) for c in ("score", "predicted", "n_hits", "node", "_t", "key", "ids", "n_words", "comp", "digest")}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns(clash)
    empty = docs.limit(0)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        last = n + 1 == len(corpus_pipeline.STAGES)
        for name, df in (("all", docs), ("none", empty)):
            stage(spark, df, FOLDER).write.parquet(f"{folder}/{name}{n}")
        docs, empty = (spark.read.parquet(f"{folder}/{name}{n}") for name in ("all", "none"))
        assert empty.count() == 0
        if not last:
            assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and set(clash) <= set(docs.columns)
            assert {r["doc_id"] for r in docs.collect()} >= {1, 3, 4, 5, 6, 7, None}
    assert {r["doc_id"] for r in docs.collect()} == {1, 3, 4, 5, 6, 7, None}
    assert docs.where("doc_id in (3, 4)").agg(F.sum("length")).first()[0] == 2


def test_pipeline_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        if n + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns and 0 < docs.count() <= kept
            kept = docs.count()
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {r["doc_id"] for r in spark.read.parquet(f"{folder}/{n - 1}").collect()}
    assert E.queries()["pipeline"] is corpus_pipeline.run
