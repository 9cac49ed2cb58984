"""Collocations against counting every phrase of the whole texts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from riskspark.llm import phrases as P
from riskspark.llm.shared import UPPER, lower_bytes, text_bytes

LOWER = str.maketrans(UPPER, UPPER.lower())


def _pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def _brute(rows, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in _pieces(text):
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * candidates[q]}
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def _rows():
    rng = random.Random(12)
    words = ["a", "B", "the", "ÉTÉ", "été", "new", "york", "city", "x\x00y", "of", "日本", "it's", " "]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(words) + rng.choice([" "] * 12 + ["\t ", ", ", ".\n", "; ", "!\r\n", "\x0b"]) for _ in range(rng.randint(0, 120)))
        rows.append((text, rng.choice(["en", "fr", None, "und", ""])))
    rows += [("New York City is a passage that many documents share, word for word.", "en")] * 60
    rows += [(None, "en"), ("", None), ("...,,!", "de"), ("one two three " * 3000, "long"), ("w" * 200_000 + " q", "en")]
    return rows


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "x", 2) for i, (t, g) in enumerate(rows)],
                                 "doc_id long, text string, lang string, own int, chunk string, n long")


def test_against_every_phrase(spark):
    rows = _rows()
    got = sorted(map(tuple, P.collocations(_docs(spark, rows)).collect()))
    assert got == _brute(rows)
    assert {r[0] for r in got} >= {"en", "fr", "und", "", "long"}


def test_small_filters_change_nothing(spark):
    rows = _rows()
    got = sorted(map(tuple, P.collocations(_docs(spark, rows), least=3, top=7, filter_bits=16).collect()))
    assert got == _brute(rows, 3, 7)


def test_two_words_of_one_id_are_told_apart(spark, monkeypatch):
    """Ids that collide with the first seed are found, and all is counted anew."""
    rows = [("alpha beta alpha gamma. " * 12, "en")]
    dictionary = P.build_dictionary(_docs(spark, rows), 2)
    assert P.count_words(dictionary)[1] == 0
    broken = P._read

    def read(batch, seed):
        for lang, ids, *rest in broken(batch, seed):
            yield lang, ids if seed else ids % 2, *rest

    monkeypatch.setattr(P, "_read", read)
    words, seed = P.count_words(dictionary)
    assert seed == 1 and words.count() == 3


def test_empty_table(spark):
    assert P.collocations(_docs(spark, [])).collect() == []


def test_chunks_cover_each_word_once():
    texts = [t for t, _ in _rows()]
    raw, starts = text_bytes(pa.array(texts, pa.large_string()))
    raw = lower_bytes(raw)
    row, own, first, last = P.parse(raw, starts, 2)
    seen = defaultdict(list)
    for r, n, a, b in zip(row, own, first, last):
        words = re.findall(rb"[^\x20\x09]+", raw[a:b].tobytes())
        assert 0 <= len(words) - n <= 2
        seen[int(r)] += words[:n]
    for i, text in enumerate(texts):
        assert seen[i] == [w.encode() for words in _pieces(text) for w in words]


def test_repeated_passages_share_chunks(spark):
    """A passage is parsed alike wherever it stands (but for its edges)."""
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randint(0, 500)}" for _ in range(400))
    rows = [(" ".join(f"u{rng.randint(0, 99999)}" for _ in range(50)) + " " + passage, "en") for _ in range(30)]
    chunks = P.build_dictionary(_docs(spark, rows), 2).collect()
    shared = sum(c.own for c in chunks if c.times == 30)
    assert shared > 300


def test_filter_has_no_false_negatives(spark):
    keys = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63 - 1, 500)
    df = spark.createDataFrame([(int(k),) for k in keys], "k long")
    found = P.part_filter(df, df["k"], 1 << 20)
    assert P._has(found, keys, 1 << 20).all()
    other = np.random.default_rng(2).integers(-2 ** 63, 2 ** 63 - 1, 5000)
    assert P._has(found, other, 1 << 20).mean() < 0.01
