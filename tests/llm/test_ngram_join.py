"""The n-gram join against brute force, its pieces, odd rows and hot groups."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from riskspark.llm import ngram_join as J
from riskspark.llm.components import connected_components
from riskspark.llm.shared import text_bytes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows, num=75, den=100):
    """Component of each row, by its place: links among all rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    smallest = {r: min((x for x in ids if x is not None), default=None) for r, ids in members.items()}
    return sorted(((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows))), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def _edited(words, rate, rng):
    return [rng.choice("abcdefgh") + str(rng.randrange(999)) if rng.random() < rate else w for w in words]


def _corpus(rng, n_bases=25, common=True):
    passage = [f"common{i}" for i in range(55)]
    rows = []
    for b in range(n_bases):
        size = rng.choice([3, 4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200, 700])
        base = [f"{rng.choice('xyz')}{rng.randrange(400)}" for _ in range(size)]
        for _ in range(rng.choice([1, 1, 2, 4, 9])):
            words = _edited(base, rng.choice([0, 0.01, 0.03, 0.06]), rng)
            if rng.random() < 0.3:
                words = words[:-1]
            if common and rng.random() < 0.4:
                at = rng.randrange(len(words) + 1)
                words = words[:at] + passage + words[at:]
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


def test_against_brute_force(make_docs):
    rows = _corpus(random.Random(0), 50)
    assert found(J.similar_documents(make_docs(rows))) == brute(rows)


def test_small_limits_take_every_path(make_docs, monkeypatch):
    """Stars in batches, small meetings, many blocks and buckets give the same."""
    for name, value in (("STAR_IN_BATCH", 4), ("PAIRS_UPTO", 2), ("BLOCK", 3), ("NEAREST", 2), ("ENTRIES_A_BUCKET", 3000),
                        ("COMMON_LEAST", 3), ("GROUP_BYTES", 20_000), ("SLICE_BYTES", 4_000)):
        monkeypatch.setattr(J, name, value)
    rows = _corpus(random.Random(9), 40)
    assert found(J.similar_documents(make_docs(rows))) == brute(rows)


def test_other_thresholds(make_docs):
    rows = _corpus(random.Random(3), 20, common=False)
    assert found(J.similar_documents(make_docs(rows), threshold=(60, 100))) == brute(rows, 60)


def test_hot_group_of_near_copies(make_docs):
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = [(i, " ".join(_edited(base, 0.02, rng))) for i in range(150)]
    rows += [(1000 + i, " ".join(base)) for i in range(150)] + [(2000 + i, f"u{i} " * 9 + "z z z") for i in range(20)]
    assert found(J.similar_documents(make_docs(rows))) == brute(rows)


def _met(make_docs, monkeypatch, parts):
    """Which words meet, as pairs or in one larger meeting, if each part is a
    batch and its words have the signatures given."""
    known, name = {}, {}
    for word, sigs in ((w, s) for part in parts for w, s in part.items()):
        values, bounds = J.shingle_sets(*text_bytes(pa.array([word])), 5)
        known[int(values[0])], name[int(J.set_digests(values, bounds).view(np.int64)[0])] = sigs, word

    def signatures(values, bounds, *_):
        own = [(i, s) for i, v in enumerate(values.tolist()) for s in known[v]]
        return np.array([i for i, _ in own]), np.array([s for _, s in own], np.uint64)

    monkeypatch.setattr(J, "signatures", signatures)
    docs = make_docs([(i, w) for i, part in enumerate(parts) for w in part]).repartitionByRange(len(parts), "doc_id")
    rows = J.candidates(docs, np.zeros(0, np.uint64), [], 1, 5, J.Threshold()).collect()
    meetings = {}
    for r in rows:
        if not r.is_pair:
            meetings.setdefault(r.sig, set()).add(name[r.b])
    return meetings, {frozenset((name[r.a], name[r.b])) for r in rows if r.is_pair}


def test_a_crowd_of_one_batch_meets_a_set_of_another(make_docs, monkeypatch):
    crowd = {f"x{i}": [1] for i in range(J.STAR_IN_BATCH + 6)}
    meetings, _ = _met(make_docs, monkeypatch, [crowd, {"y": [1]}])
    assert meetings[1] == {*crowd, "y"}


def test_crowds_of_two_batches_meet(make_docs, monkeypatch):
    """x holds 1 and 2, y holds 2 and 3: told under one signature in each
    batch, they would not meet."""
    one, two = ({f"{w}{i}": s for i in range(J.STAR_IN_BATCH + 6)} for w, s in (("x", [1, 2]), ("y", [2, 3])))
    meetings, _ = _met(make_docs, monkeypatch, [one, two])
    assert any({*one, *two} <= m for m in meetings.values())


def test_every_link_is_counted(make_docs, monkeypatch):
    """Within components of many blocks too: each class's links to other sets."""
    monkeypatch.setattr(J, "BLOCK", 20)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(60)]
    rows = [(i, " ".join(_edited(base, 0.02, rng))) for i in range(70)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(_corpus(rng, 8))] + [(200, rows[0][1]), (201, None), (202, "a b")]
    kinds = {shingles(t) for _, t in rows} - {frozenset()}
    links = {a: sum(a != b and 4 * len(a & b) >= 3 * len(a | b) for b in kinds) for a in kinds} | {frozenset(): 0}
    assert max(links.values()) > 20
    assert {r.doc_id: r.class_links for r in J.similar_documents(make_docs(rows)).collect()} == {
        i: links[shingles(t)] for i, t in rows}


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three four five"),
            (None, "One two"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "é É a b c d"), (9, "É é a b c d"),
            (10, "word " * 30_000), (11, "word " * 20_000), (12, "x" * 200_000)]
    assert found(J.similar_documents(make_docs(rows))) == brute(rows)
    assert J.similar_documents(make_docs([])).collect() == []
    assert found(J.similar_documents(make_docs([(None, "a b c"), (None, "A b c")]))) == [(None, 1, None)] * 2


def test_drop_similar_keeps_the_smallest_id(make_docs):
    rows = _corpus(random.Random(5))
    kept = J.drop_similar(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


def test_drop_similar_keeps_one_row_of_null_and_repeated_ids(make_docs):
    rows = [(None, "a b c"), (None, "A b C"), (1, "x y z"), (1, "p q r"), (0, "X y z"), (2, None), (None, None), (None, ""),
            (3, "m n"), (3, "m n"), (None, "x y z"), (4, "alone")]
    kept = J.drop_similar(make_docs(rows)).collect()
    found = sorted(((r.doc_id, (r.text or "").lower()) for r in kept), key=str)
    assert found == sorted([(None, "a b c"), (1, "p q r"), (0, "x y z"), (2, ""), (None, ""), (None, ""), (3, "m n"),
                            (4, "alone")], key=str)


def test_signatures_meet_for_every_linked_pair():
    """Pigeonhole: linked sets of all sizes share a signature, whatever is common."""
    rng, t = np.random.default_rng(1), J.Threshold()
    for share in (0.0, 0.3, 1.0):
        edges = J.band_edges(3000, t)
        bands = J.allocate(edges, [share] * len(edges), t)
        assert (bands[0].segments == 1) == (share == 0.3)  # one-deletion neighbourhoods
        for size in [*range(1, 60), 95, 96, 130, 383, 384, 600, 2000]:
            for _ in range(6):
                one = rng.integers(0, 2 ** 63, size).astype(np.uint64)
                lost = rng.integers(0, max(1, size // 5) + 1)
                two = np.concatenate([one[lost:], rng.integers(0, 2 ** 63, rng.integers(0, max(1, size // 6) + 1)).astype(np.uint64)])
                both = len(np.intersect1d(one, two))
                if not len(two) or both * t.den < (len(one) + len(two) - both) * t.num:
                    continue
                values = np.concatenate([np.sort(one), np.sort(two)])
                bounds = np.array([0, len(one), len(values)])
                usual = rng.random(len(values)) < 0.5
                usual = np.isin(values, values[usual])  # the same for equal elements
                which, sig = J.signatures(values, bounds, usual, bands, t)
                assert set(sig[which == 0]) & set(sig[which == 1]), (size, lost)


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(200):
        one = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 500)).astype(np.uint64))
        keep = one[rng.random(len(one)) < rng.random()]
        two = np.unique(np.concatenate([keep, rng.integers(0, 2 ** 63, rng.integers(1, 300)).astype(np.uint64)]))
        x, y = J.parity_sketches(np.concatenate([one, two]), np.array([0, len(one), len(one) + len(two)]))
        assert J.least_difference(x, y) <= len(np.setxor1d(one, two))


def test_shingle_sets_of_slices_and_nulls():
    texts = ["a b c d e f", None, "", "A b C", "a b c"]
    raw, starts = text_bytes(pa.array(["zz", *texts]).slice(1))
    values, bounds = J.shingle_sets(raw, starts, 5)
    assert np.diff(bounds).tolist() == [2, 0, 0, 1, 1]
    assert values[bounds[3]] == values[bounds[4]]


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(300, 500)] + [(7, 7), (600, 601), (601, 600)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 300 for i in [*range(300, 500), 1000]} | {600: 600, 601: 600}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
