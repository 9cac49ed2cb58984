"""Source divergence against plain counting, and the transducers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from riskspark.llm import divergence as D
from riskspark.llm.shared import UPPER

LOWER = str.maketrans(UPPER, UPPER.lower())


def _brute(rows, least=30, top=50):
    documents, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        documents[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang in documents:
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = sorted(s for g, s in counts if g == lang)

        def shares(c):
            return [1 + 1000000000 * (c[t] + 5) // (sum(c[t] for t in kept) + 5 * len(kept)) for t in kept]

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(abs(a - b) for a, b in zip(p[s], p[o])), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)]
            terms = sorted((b - a, t.encode()) for t, a, b in zip(kept, p[s], q) if counts[lang, s][t] and a > b)
            out += [(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(terms[:top])]
    return sorted(out)


def _rows():
    rng = random.Random(13)
    words = ["the", "The", "été", "a", "ab", "abc", "日本語", "x1y", "don't", "internationalisation", "internationally",
             "internationalise", "zebra", "z", "é", "ß"] + [f"w{c}{d}" for c in "abcdef" for d in "xyz"]
    rows = [(" ".join(rng.choices(words, [rng.random() for _ in words], k=rng.randint(0, 60))),
             rng.choice(["en", "en", "fr", None]), rng.choice(["s1", "s1", "s1", "s2", "S3", "é", None])) for _ in range(400)]
    rows += [("the same text", "en", "s1")] * 100  # repeated rows
    rows += [(None, "en", "empty"), ("", "xx", "a"), ("rare words", "xx", "b"), ("12 34", None, None), ("abc " * 30_000, "en", "s2")]
    return rows


def _docs(spark, rows):
    return spark.createDataFrame([(i, *r, 1, "x", 2) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n long, term string, number long")


def test_against_plain_counts(spark):
    rows = _rows()
    got = sorted(map(tuple, D.source_divergence(_docs(spark, rows)).collect()))
    assert got == _brute(rows)
    assert {("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)} <= set(got)


def test_shards_passes_and_blocks(spark, monkeypatch):
    """Many transducers, a pass for each, and pairs over several blocks."""
    monkeypatch.setattr(D, "TERMS", 5)
    monkeypatch.setattr(D, "SOURCES", 2)
    rows = _rows()
    got = D.source_divergence(_docs(spark, rows), least_documents=10, top_terms=4, shard_terms=3, vocabulary_bytes=500)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 10, 4)


def test_empty_table(spark):
    assert D.source_divergence(_docs(spark, [])).collect() == []


def _lookup(t, words, start=0):
    raw = np.frombuffer(b"".join(words) or b"\0", np.uint8)
    last = np.cumsum([len(w) for w in words])
    first = last - [len(w) for w in words]
    return t.ordinals(raw, first, last, np.full(len(words), start)).tolist()


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(2)
    terms = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))) for _ in range(400)})
    t = D.Transducer.from_bytes(*D.Transducer.of_sorted(terms).to_bytes())
    assert _lookup(t, terms) == list(range(len(terms)))
    assert [t.term(i) for i in range(len(terms))] == terms
    other = [w for w in {bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 9))) for _ in range(400)} if w not in terms]
    assert set(_lookup(t, other)) == {-1}
    endings = {frozenset(w[len(p):] for w in terms if w.startswith(p)) for w in terms for p in (w[:k] for k in range(len(w) + 1))}
    assert len(t.final) == len(endings)  # one state for each set of endings


def test_transducers_side_by_side():
    some = [D.Transducer.of_sorted(x) for x in ([b"a", b"ab"], [b"b"], [])]
    table, starts = D.Transducer.side_by_side(some)
    assert _lookup(table, [b"a", b"ab", b"b"], starts[0]) == [0, 1, -1]
    assert _lookup(table, [b"a", b"b"], starts[1]) == [-1, 0]
    assert _lookup(table, [b"a"], starts[2]) == [-1]
    assert table.term(1, int(starts[0])) == b"ab"
    assert D.Transducer.side_by_side([])[0].keys.size == 0
