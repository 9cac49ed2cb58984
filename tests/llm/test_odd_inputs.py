"""Inputs that once lost rows or stopped a job."""

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm.exact_dedup import drop_exact_copies
from riskspark.llm.language import keep_identified, viterbi
from riskspark.llm.ngram_join import drop_similar


def test_without_any_label_only_letterless_texts_go(make_docs):
    rows = [(1, "some words"), (2, "12 34"), (3, None), (4, "été"), (5, ""), (None, "words"), (None, "..."), (6, "日本")]
    kept = keep_identified(make_docs(rows))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 6]


def test_letterless_rows_of_null_and_repeated_ids_go(make_docs):
    rows = [(i, f"the quick brown fox number {w} jumps over the lazy dog", "en") for i, w in enumerate("abcdefghij")]
    rows += [(20, "1234", "en"), (None, "999", "en"), (None, "words here", "en"), (30, "--", "en"), (30, "a word", "en")]
    kept = keep_identified(make_docs(rows)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted([*map(str, range(10)), "None", "30"])
    assert {r.text for r in kept if r.doc_id in (None, 30)} == {"words here", "a word"}


def test_viterbi_tells_hundreds_of_languages_apart():
    scores = np.zeros((6, 300), np.float32)
    best = [150, 150, 299, 127, 128, 200]
    scores[np.arange(6), best] = 100
    assert viterbi(scores, np.array([0, 3, 6])).tolist() == best


def test_columns_that_cannot_be_ordered(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (2, text), (None, text + " more"), (3, "other"), (3, "other"), (3, text), (None, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    exact = drop_exact_copies(docs)
    assert exact.columns == docs.columns
    assert sorted((r.text[:5], r.doc_id is None) for r in exact.collect()) == [("other", False), ("w0 w1", False), ("w0 w1", True)]
    similar = drop_similar(docs)
    assert similar.columns == docs.columns
    assert sorted((r.text[:5], r.doc_id) for r in similar.collect()) == [("other", 3), ("w0 w1", 1)]
