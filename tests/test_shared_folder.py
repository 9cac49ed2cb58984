"""On a cluster, intermediates go to the folder that the platform names, also
where that is a mount with a local path; folders that are not shared are refused."""

import random

import pytest

import __spark_entry__ as E
from riskspark import session
from riskspark.llm.shared import shared_dir, stage
from riskspark.sources.driver_adapter import driver_tables

from .conftest import SF_SMALL

_PICK = random.Random(5)
_WORDS = ["the", "dog", "and", "cat", "sat", "by", "a", "door", "THE", "old", "house.", "red\n", "tree!"]
_RUDE = ["you", "idiot", "you", "scum", "filthy", "trash"]
DOCS = [(i, " ".join(_PICK.choices(_WORDS, k=_PICK.randint(8, 60)) + _RUDE * (i % 5 == 0)), "en", ["web", "news"][i % 2]) for i in range(120)]
DOCS[7] = (7, DOCS[6][1], "en", "web")


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session, as if its master were a cluster's."""
    monkeypatch.setattr(session, "_is_local", lambda _: False)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_proven", set(), raising=False)
    return spark


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    vectors = [(i, [1.0, 0.0] if i < 2 else [0.0, float(i)]) for i in range(5)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(i, f"http://a.b/{i}", "<p>x</p>") for i in range(3)], "page_id long, url string, html string") \
        .write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, int(len(text) > 150), int(i % 5 == 0)) for i, text, _, _ in DOCS]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_the_named_folder_may_be_a_mount(cluster):
    named = session.named_folder(cluster)
    place = "/" + named.removeprefix("file:").strip("/")
    for path in (named, place, f"file://{place}/", f"file:{place}/a/b"):
        assert session.shared_path(cluster, path) == path.rstrip("/")
    for path in (f"{place}-other", f"file://{place}/../x", "/", "file:///tmp"):
        with pytest.raises(RuntimeError):
            session.shared_path(cluster, path)
    assert session.ensure_checkpoint_dir(cluster) == named
    assert shared_dir(cluster) == named.rstrip("/")
    assert stage(cluster.range(7), "test-mount").count() == 7


def test_it_is_tried_once_and_leaves_nothing(cluster, monkeypatch):
    tried, seen = [], session._rows_seen
    monkeypatch.setattr(session, "_rows_seen", lambda spark, path, n: tried.append(path) or seen(spark, path, n))
    for _ in range(3):
        shared_dir(cluster)
    assert len(tried) == 1
    path = cluster._jvm.org.apache.hadoop.fs.Path(tried[0])
    assert not path.getFileSystem(cluster._jsc.hadoopConfiguration()).exists(path)


def test_a_folder_of_each_machine_is_refused(cluster, monkeypatch):
    monkeypatch.setattr(session, "_rows_seen", lambda spark, path, n: n - 1)  # one task's file stays on its machine
    with pytest.raises(RuntimeError):
        shared_dir(cluster)
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(cluster)


@pytest.mark.parametrize("name", [
    "op1_ngram_join", "op3_exact_dedup", "op4_exact_topk", "op5_token_counts", "op6_warc", "op7_source_mix",
    "op8_best_fit_packing", "op9_quality_rules", "op10_toxicity_chain", "op11_embedding_near_dedup",
    "op12_phrase_collocations", "op13_source_divergence"])
def test_operators_run_on_a_cluster_with_a_mount(cluster, sf_dir, name):
    rows = E.queries()[name](cluster, sf_dir).count()
    if name in ("op8_best_fit_packing", "op12_phrase_collocations", "op13_source_divergence"):
        assert rows > 0
    else:
        assert rows == {"op4_exact_topk": 4, "op6_warc": 3, "op11_embedding_near_dedup": 5}.get(name, len(DOCS))


def test_the_pipeline_runs_on_a_cluster_with_a_mount(cluster, sf_dir):
    docs = E.queries()["pipeline"](cluster, sf_dir)
    assert docs.filter("doc_id in (6, 7)").select("doc_id").distinct().count() == 1


@pytest.mark.parametrize("name", ["transaction_rollup", "loss_bps_month"])
def test_ledger_states_on_a_cluster_with_a_mount(cluster, name):
    wanted = E.QUERIES[name](driver_tables(cluster, SF_SMALL, fresh=True), E.PARAMS).collect()
    found = E.queries()[f"{name}_from_states"](cluster, SF_SMALL).collect()
    assert len(wanted) and sorted(map(repr, found)) == sorted(map(repr, wanted))
