"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from riskspark.llm import queries as Q
from riskspark.llm.shared import stage
from riskspark.testing.compare import compare, duck_connection

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries())
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duck_connection(SF, tables=("documents", "embeddings", "pages"))
    c = compare(name, Q.QUERIES[name](spark, SF), con, Q.ORACLE_SQL[name])
    assert c.ok, c.detail
    assert c.spark_rows > 0


def test_pipeline_stages(spark):
    """Each stage on its predecessor's result, against plain Python."""
    from tests.llm.test_native_operators import _norm, _targets, _words
    from tests.llm.test_ngram_join import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), f"test-{name}")
        kept[name] = docs.collect()
        assert docs.columns == columns or name == "best_fit_packing"
    assert [n for n, _ in corpus_pipeline.STAGES] == list(kept)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in kept["language"]} == set(text)  # every document here has letters
    best = {}
    for i, t in text.items():
        best[_norm(t)] = max(best.get(_norm(t), -1), i)
    assert {r.doc_id for r in kept["exact_dedup"]} == set(best.values())
    rows = [(i, text[i]) for i in best.values()]
    assert {r.doc_id for r in kept["ngram_join"]} == {c for _, _, c in brute(rows)}
    sizes, taken = {}, {}
    for r in kept["ngram_join"]:
        sizes[r.source] = sizes.get(r.source, 0) + _words(r.text)
    for r in kept["source_mix"]:
        taken[r.source] = taken.get(r.source, 0) + _words(r.text)
    longest = max(_words(r.text) for r in kept["ngram_join"])
    assert all(abs(taken.get(s, 0) - t) <= longest / 2 for s, t in _targets(sizes).items())
    pieces = kept["best_fit_packing"]
    assert {r.doc_id for r in pieces} == {r.doc_id for r in kept["source_mix"]}
    assert sum(r.piece == 0 for r in pieces) == len(kept["source_mix"])


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns[0] == "doc_id"
    assert corpus_pipeline.ORACLE_SQL is None
