"""The registered queries against their SQL, and the pipeline's stages against plain versions."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from layerflow.llm import queries
from layerflow.llm.common import written
from tests.llm.test_operators import brute_components, brute_exact

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    order = sorted(df.columns)
    got = Counter(tuple(r[c] for c in order) for r in df.collect())
    res = con.execute(queries.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == order
    assert got == Counter(tuple(r[names.index(c)] for c in order) for r in res.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        columns = docs.columns
        docs = written(stage(spark, docs, SF), name)
        kept[name] = docs
        ids = sorted(r.doc_id for r in docs.select("doc_id").distinct().collect())
        if name == "exact_dedup":
            assert ids == sorted(r[0] for r in brute_exact(before) if r[3])
        if name == "ngram_jaccard":
            assert ids == sorted(r[0] for r in brute_components(before, 5, 80) if r[0] == r[2])
        if name in ("pii_pseudonyms", "best_fit"):
            assert ids == sorted(d for d, _ in before)
        if name != "best_fit":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == list(kept)
    assert corpus_pipeline.run(spark, SF).count() == kept["best_fit"].count()


def test_pipeline_takes_edge_cases(spark, documents, nothing):
    from pyspark.sql import functions as F

    for start, empty in ((documents, False), (nothing, True)):
        docs = start.withColumn("n_chars", F.length("text").cast("bigint"))
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), name)
        assert (docs.count() == 0) == empty
