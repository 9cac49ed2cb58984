"""Near-duplicate vectors against all pairs."""

import math
import random

import numpy as np

from riskspark.llm import embedding_dups as E


def _brute(rows, threshold=0.9):
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    width = max([len(v) for _, v in rows if usable(v)], default=0)
    unit = [np.array([float(np.float32(x)) for x in v] + [0.0] * (width - len(v))) if usable(v) else None for _, v in rows]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    out, part = [], list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(unit):
        for j in range(i):
            if a is not None and unit[j] is not None and a @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                part[root(i)] = root(j)
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((vec_id, links[i], least, vec_id == least))
    return sorted(out, key=str)


def _rows(rng, near=0.08):
    gauss = lambda n=16: [rng.gauss(0, 1) for _ in range(n)]
    rows = [(i, gauss()) for i in range(300)]
    hot = gauss()
    rows += [(1000 + i, [x + rng.gauss(0, near) for x in hot]) for i in range(150)]  # a large group of near copies
    rows += [(2000 + i, [x * 3 for x in hot]) for i in range(40)]  # and of copies
    at = gauss()
    for i in range(12):  # a chain: neighbours link, ends do not
        at = [x + rng.gauss(0, 0.2) for x in at]
        rows.append((3000 + i, at))
    rows += [(4000, None), (4001, []), (4002, [0.0] * 16), (4003, [1.0, None]), (4004, [float("nan")] * 16),
             (4005, [float("inf")] * 16), (None, hot), (None, gauss()), (5, hot), (5, hot), (4006, [1.0]), (4007, [2.0])]
    return rows


def _got(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, cid int, v int, h1 int")
    return sorted(map(tuple, E.near_duplicates(df, **options).collect()), key=str)


def test_against_all_pairs(spark):
    rows = _rows(random.Random(11))
    assert _got(spark, rows) == _brute(rows)


def test_blocks_of_crowded_buckets(spark):
    rows = _rows(random.Random(12))
    assert _got(spark, rows, block=20) == _brute(rows)


def test_few_and_none(spark):
    assert _got(spark, []) == []
    for rows in ([(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [2.0, 1.0])]):
        assert _got(spark, rows) == _brute(rows)


def test_recall_at_the_threshold():
    """Pairs placed a little above the threshold meet as often as promised."""
    rng = np.random.default_rng(3)
    sample = rng.standard_normal((4000, 64))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    index = E.fit(sample, 1_000_000, 0.9)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    aside = rng.standard_normal(a.shape)
    aside -= (a * aside).sum(1, keepdims=True) * a
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    b = 0.91 * a + math.sqrt(1 - 0.91 ** 2) * aside
    one, two = index.codes(a), index.codes(b)
    meets = (index.keys(one) == index.keys(two)).any(1) & (E.distances(one, two) <= index.radius)
    assert meets.mean() > 0.95
    balance = np.unpackbits(index.codes(sample)[:, :1].copy().view(np.uint8), axis=1).mean(0)
    assert (abs(balance - 0.5) < 0.1).all()


def test_rotation_lowers_the_loss():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 8)) * np.linspace(3, 0.3, 8)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    loss = lambda p: (((x @ p) - np.where(x @ p > 0, 1, -1)) ** 2).sum()
    assert loss(E.learn_rotation(x, axes, rng)) < loss(axes)


def test_each_pair_is_looked_at_once():
    sizes = np.array([1, 5, 300, 2, 600, 0])
    end = np.cumsum(sizes)
    begin, end = (end - sizes)[sizes > 0], end[sizes > 0]
    across = np.array([False, False, False, False, True])
    second = np.zeros(end[-1], bool)
    second[begin[-1] + 250:] = True
    got = [(int(a), int(b)) for i, j in E.meetings(begin, end, across, second) for a, b in zip(i, j)]
    want = [(a, b) for s, e in zip(begin[:-1], end[:-1]) for a in range(s, e) for b in range(a + 1, e)]
    want += [(a, b) for a in range(begin[-1], begin[-1] + 250) for b in range(begin[-1] + 250, end[-1])]
    assert len(got) == len(want) and set(got) == set(want)
