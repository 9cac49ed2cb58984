"""Language, quality and toxicity: held-out accuracy, odd rows, pieces against brute force."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskspark.llm import language as L
from riskspark.llm import queries as Q
from riskspark.llm.quality import STATISTICS, score_quality, statistics
from riskspark.llm.shared import text_bytes
from riskspark.llm.toxicity import FeatureTable, fit_chain, toxic_documents, word_features

SF = "/root/testdata/sf0.01"


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    for lengths in ([4, 1, 0, 6], [5], [0, 0], [3, 3, 2]):
        rows = np.concatenate([[0], np.cumsum(lengths)])
        scores = rng.normal(size=(rows[-1], 3)).astype(np.float32) * 3
        labels = L.viterbi(scores, rows, 2.0)
        for lo, hi in zip(rows[:-1], rows[1:]):
            value = lambda path: sum(scores[lo + i, x] for i, x in enumerate(path)) - 2.0 * sum(
                x != y for x, y in zip(path, path[1:]))
            if hi > lo:
                best = max(value(p) for p in itertools.product(range(3), repeat=hi - lo))
                assert abs(value(labels[lo:hi].tolist()) - best) < 1e-4


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = Q.op2_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == docs.count() and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


TRAIN = [(3 * i, t, lang) for i, (t, lang) in enumerate(
    [("the cat and the dog went to the house with this thing", "en"), ("der hund und die katze nicht für das haus über", "de"),
     ("это собака и кошка в доме", "ru")] * 40)]


def _model(make_docs):
    return L.train_language_model(make_docs(TRAIN))


def test_spans_scripts_and_odd_texts(make_docs):
    mixed = "the dog and the house with the cat and this thing " * 2
    texts = {1: None, 2: "", 3: " 12 !? ...", 4: "🙂 — “”", 5: mixed + "собака и кошка в доме это", 6: "кошка", 7: "THE CAT",
             8: "µ", 9: "the " * 50_000, None: "und die katze", 10: "日本"}
    model = _model(make_docs)
    assert model.languages == ["de", "en", "ru"]
    found = {r.doc_id: r for r in L.label_languages(make_docs(list(texts.items())), model).collect()}
    for i in (1, 2, 3, 4):
        assert (found[i].lang_pred, found[i].score, len(found[i].spans)) == ("und", 0.0, len(found[i].spans))
    assert found[5].lang_pred == "en" and [s.lang for s in found[5].spans] == ["en", "ru"]
    raw = texts[5].encode()
    assert raw[found[5].spans[1].start:found[5].spans[1].end].decode() == "собака и кошка в доме это"
    assert found[6].lang_pred == "ru" and found[7].lang_pred == "en" and found[9].lang_pred == "en"
    assert found[8].lang_pred in model.languages and found[10].lang_pred in model.languages and found[None].lang_pred == "de"
    empty = L.label_languages(make_docs([]), model)
    assert empty.collect() == []
    nothing = L.label_languages(make_docs([(1, "abc")]), L.train_language_model(make_docs([(1, "abc")])))
    assert [(r.lang_pred, r.score) for r in nothing.collect()] == [("und", 0.0)]


def test_keep_identified(make_docs):
    rows = TRAIN + [(1000, None), (1001, "..."), (None, "!!"), (1002, "the cat and the dog"), (1003, "123")]
    kept = L.keep_identified(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in TRAIN} | {1002, None}


def test_keep_identified_keeps_texts_of_three_languages(make_docs):
    own = {}
    for _, text, lang in TRAIN:
        if text and lang:
            own.setdefault(lang, text)
    assert len(own) >= 3
    mixed = " ".join(" ".join([own[lang]] * 6) for lang in sorted(own)[:3])
    rows = TRAIN + [(3000, mixed)]
    score = {r.doc_id: r.score for r in L.identify_languages(make_docs(rows)).collect()}[3000]
    assert 0.2 < score < 0.5
    assert 3000 in {r.doc_id for r in L.keep_identified(make_docs(rows)).collect()}


def test_statistics_by_hand():
    texts = ["Ab cd cd!\nAb cd cd!\n\nX", "", " \n", None, "É" * 3]
    raw, starts = text_bytes(pa.array(texts))
    found = [dict(zip(STATISTICS, row)) for row in statistics(raw, starts)]
    one = found[0]
    assert one["log_words"] == pytest.approx(np.log1p(7)) and one["distinct_words"] == pytest.approx(4 / 7)
    assert one["top_word"] == pytest.approx(2 / 7) and one["repeats_previous"] == 0
    assert one["distinct_pairs"] == pytest.approx(4 / 6)  # ab-cd, cd-cd!, cd!-ab, cd!-x
    assert one["line_length"] == pytest.approx(7 / 3) and one["repeated_lines"] == pytest.approx(1 / 3)
    assert one["lines_end_open"] == pytest.approx(1 / 3) and one["upper"] == pytest.approx(3 / len(texts[0]))
    for i in (1, 2, 3):
        assert found[i]["log_words"] == 0 and found[i]["repeated_lines"] == 0
    assert found[4]["wide"] == 1


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = Q.op9_quality_rules(spark, SF).join(labels, "doc_id", "left").collect()
    held = [r for r in found if r.held_out and r.quality is not None]
    assert len(found) == 1000 and len(held) > 40
    assert sum(r.quality == r.predicted for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_quality_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "text here"), (3, "w " * 50_000), (4, "A!! B!!"), (4, "A!! B!!")]
    for labels, score in (([], 0.5), ([(1, 1), (2, 1), (7, None)], 1.0), ([(1, 0)], 0.0)):
        found = score_quality(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(found) == 6 and {r.score for r in found} == {score}
    assert score_quality(make_docs([]), spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = Q.op10_toxicity_chain(spark, sf).join(labels, "doc_id", "left").collect()
    held = [r for r in found if r.held_out and r.toxic is not None]
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.01 * len(held)


def test_toxicity_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "text here"), (3, "w " * 50_000), (4, "bad word"), (4, "bad word")]
    for labels, score in (([], 0.0), ([(1, 1), (2, 1), (7, None)], 1.0), ([(1, 0)], 0.0)):
        found = toxic_documents(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len(found) == 6 and {r.score for r in found} == {score}
    both = [(i, f"plain text number{i} idiot loser" if i % 3 == 0 else f"plain text number{i}") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    extra = [(200, "some idiot loser"), (201, "some text"), (202, None)]
    found = {r.doc_id: r.predicted for r in toxic_documents(make_docs(both + extra), labels).collect()}
    assert all(found[i] == (i % 3 == 0) for i in range(90)) and (found[200], found[201], found[202]) == (1, 0, 0)
    assert toxic_documents(make_docs([]), labels).collect() == []


def test_chain_uses_earlier_categories():
    """A later category that is the earlier one plus a word is learned through it."""
    rng = np.random.default_rng(3)
    has = rng.random((3000, 6)) < 0.3
    early = has[:, 0] | has[:, 1]
    late = early & has[:, 2]
    row, feature = np.nonzero(has)
    chain = fit_chain(["early", "late"], np.arange(6, dtype=np.uint64), row, feature,
                      np.column_stack([early, late]).astype(float))
    found = chain.predict(3000, row, feature) > 0.5
    assert (found[:, 0] == early).mean() > 0.99 and (found[:, 1] == late).mean() > 0.97
    assert chain.earlier[1, 0] > 1


def test_word_features_of_beginnings():
    raw, starts = text_bytes(pa.array(["Abcdefgh!", "abcdeZ", "abcd"]))
    row, found, whole = word_features(raw, starts)
    by = {i: set(found[(row == i) & ~whole].tolist()) for i in range(3)}
    assert len(by[0]) == 3 and len(by[1]) == 2 and not by[2]
    assert len(by[0] & by[1]) == 2
    table = FeatureTable(found[(row == 0) & whole])
    assert table.present(raw, starts)[0].tolist() == [0]
