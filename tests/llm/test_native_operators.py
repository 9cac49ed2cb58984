"""Exact dedup and mixing: brute force, odd rows, skew, plans without Python."""

import contextlib
import hashlib
import io
import random
import re

from riskspark.llm.exact_dedup import build_directory, drop_exact_copies, exact_dedup
from riskspark.llm.mixing import pareto_mix, repeat_mixed
from riskspark.llm.shared import stage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _norm(text):
    return (text or "").translate(LOWER)


ODD = [(1, None), (2, ""), (3, "Abc"), (4, "aBC"), (5, "É"), (6, "é"), (7, "x" * 300_000), (8, "X" * 300_000),
       (9, "abc "), (10, " "), (None, "ABC"), (3, "Abc"), (11, "İ"), (12, "i̇"), (4, "other")]


def _brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(_norm(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[_norm(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), hashlib.sha256(_norm(text).encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


def _check_dedup(df, rows):
    found = df.collect()
    expected, groups = _brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected
    assert sum(r.kept for r in found) == groups
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_dedup_odd_rows_and_weak_keys(make_docs):
    _check_dedup(exact_dedup(make_docs(ODD)), ODD)
    random.seed(5)
    many = [(i, random.choice("aAbBcC") * random.randint(1, 30)) for i in range(300)]
    # two-bit keys: every key stands for many texts, and no bucket can be split further
    for bits, capacity in ((64, 8), (2, 8), (6, 1), (64, 100_000)):
        _check_dedup(exact_dedup(make_docs(many + ODD), key_bits=bits, capacity=capacity), many + ODD)


def test_dedup_hot_group_and_empty(make_docs):
    hot = [(i, "Same text" if i % 3 else "same TEXT") for i in range(3000)] + [(5000, "alone")]
    _check_dedup(exact_dedup(make_docs(hot)), hot)
    assert exact_dedup(make_docs([])).collect() == []


def test_directory_buckets_hold_their_capacity(spark):
    keys = stage(spark.range(5000).selectExpr("xxhash64(id) as key"), "test-keys")
    directory, depth = build_directory(keys, 100)
    slots = keys.selectExpr(f"shiftrightunsigned(key, {64 - depth}) as slot").join(directory, "slot")
    loads = [r["count"] for r in slots.groupBy("depth", "bucket").count().collect()]
    assert sum(loads) == 5000 and max(loads) <= 100 and len(loads) >= 50


def test_drop_exact_copies_keeps_one_row_of_each_text(make_docs):
    kept = drop_exact_copies(make_docs(ODD))
    assert kept.columns == make_docs(ODD).columns
    found = sorted((r.doc_id is not None, r.doc_id or 0, _norm(r.text)) for r in kept.collect())
    best = {}
    for doc_id, text in ODD:
        best[_norm(text)] = max(best.get(_norm(text), (False, 0)), (doc_id is not None, doc_id or 0))
    assert found == sorted((*v, k) for k, v in best.items())


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes):
    """Water filling by rounds: source -> target."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_meets_targets(make_docs):
    random.seed(1)
    rows = [(i, "w " * random.randint(1, 80), "en", random.choice(["a", "b", "c", "é", None, "hot", "hot", "hot"]))
            for i in range(2000)]
    found = {r.doc_id: r for r in pareto_mix(make_docs(rows)).collect()}
    sizes, taken = {}, {}
    for i, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + _words(text)
        taken[source] = taken.get(source, 0) + found[i].taken
        assert found[i].size == _words(text) and found[i].taken <= 2 * found[i].size
        assert found[i].taken == found[i].copies * found[i].size
    for i, _, _, source in rows:
        assert found[i].source_size == sizes[source]
        assert abs(found[i].target - _targets(sizes)[source]) < 1e-6
    for source, target in _targets(sizes).items():
        assert abs(taken[source] - target) <= 40  # half a document
    again = {r.doc_id: r.taken for r in pareto_mix(make_docs(rows).repartition(5)).collect()}
    assert again == {i: r.taken for i, r in found.items()}


def test_mix_unequal_weights_inside_a_source(spark):
    docs = spark.range(4000).selectExpr(
        "id as doc_id", "'a b c d' as text", "if(id % 2 = 0, 'x', 'y') as source",
        "if(id % 4 < 2, 3.0, 1.0) as weight")
    found = pareto_mix(docs, weight_col="weight", total_share=0.5, weights=(1,)).collect()
    mean = lambda rest: sum(r.copies for r in found if (r.doc_id % 4 < 2) == rest) / 2000
    assert abs(mean(True) / mean(False) - 3) < 0.4
    assert abs(sum(r.taken for r in found) - 8000) <= 8


def test_mix_odd_rows(make_docs):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (3, "  \n ", None, None), (None, "x y", None, "b"),
            (4, "x", None, "b"), (4, "x", None, "b"), (5, "w " * 50_000, None, "c")]
    found = pareto_mix(make_docs(rows)).collect()
    assert len(found) == len(rows) and all(r.taken <= 2 * r.size for r in found)
    assert pareto_mix(make_docs([])).collect() == []
    nothing = pareto_mix(make_docs([(1, None), (2, "")])).collect()
    assert [r.taken for r in nothing] == [0, 0]


def test_repeat_mixed_writes_the_copies(make_docs):
    rows = [(i, "w " * (i % 50 + 1), "en", "ab"[i % 2]) for i in range(400)]
    mix = {r.doc_id: r.copies for r in pareto_mix(make_docs(rows)).collect()}
    out = repeat_mixed(make_docs(rows))
    assert out.columns == make_docs(rows).columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: c for i, c in mix.items() if c}


def test_repeat_mixed_gives_each_row_its_copies(make_docs):
    """Null and repeated ids too: the words written are those taken."""
    rows = [([None, i // 4, 1000 + i][i % 3], "w " * (i % 50 + 1), "en", "abc"[i % 7 % 3]) for i in range(600)]
    taken, written = {}, {}
    for (_, _, _, source), size in zip(rows, [0] * len(rows), strict=True):
        taken[source] = written[source] = size
    targets = {}
    for r in pareto_mix(make_docs(rows)).collect():
        targets[r.source_size] = targets.get(r.source_size, 0) + r.taken
    for r in repeat_mixed(make_docs(rows)).collect():
        written[r.source] += _words(r.text)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + _words(text)
    assert len(set(sizes.values())) == len(sizes)
    assert written == {source: targets[size] for source, size in sizes.items()}


def test_native_plans(make_docs):
    rows = [(i, f"text {i}", "en", "a") for i in range(20)]
    for df in (exact_dedup(make_docs(rows)), pareto_mix(make_docs(rows)), drop_exact_copies(make_docs(rows))):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("extended")
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", buf.getvalue())
