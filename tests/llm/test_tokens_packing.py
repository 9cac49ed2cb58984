"""Token counts against the tokenizers library and packing as an exact round trip."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskspark.llm.packing import best_fit, cut_pieces, pack, pack_documents
from riskspark.llm.queries import tokenizer_path
from riskspark.llm.shared import stage_path
from riskspark.llm.tokens import CACHE_SCHEMA, Encoder, count_tokens

ODD = ["", " ", "\n\n\n  x", "don't I'LL 123 45a", "<|endoftext|> a<|endoftext|>", "naïve Ünï ñ œuvre", "日本語 テキスト", "🙂🙂 ok",
       "é́    tab\tx", "a" * 5000, "ab" * 3000 + " " + "!" * 2000, " " * 3000 + "z", "\u0085x​﻿", "٣٤ ⅷ ²"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(reference):
    enc = Encoder(tokenizer_path())
    assert enc._fast is not None
    texts = list(ODD)
    for c in map(chr, range(1, 256)):  # every character that takes the fast path
        texts += [f"a{c}b", f"{c}{c} {c}1{c}\n{c}'s", f" {c}"]
    random.seed(3)
    texts += ["".join(random.choice("aé ß\t\n1'!sTŽ日 .<|>") for _ in range(60)) for _ in range(300)]
    for text in texts:
        assert enc.encode(text).tolist() == reference(text), repr(text)


def test_other_tokenizers_use_the_library():
    path = tokenizer_path("word_bpe_49k.json")
    enc = Encoder(path)
    assert enc._fast is None
    assert enc.encode("Hello the world").tolist() == Tokenizer.from_file(path).encode(
        "Hello the world", add_special_tokens=False).ids


def test_counts_and_cache(spark, make_docs, reference):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "x y"), (3, "again"), (3, "again"), (3, ODD[3])]
    rows += [(200 + i, "hot copy of a text") for i in range(200)]
    cache = stage_path(spark, "test-cache")
    expected = sorted(((d, len((t or "").encode()), len(reference(t))) for d, t in rows), key=str)
    for _ in range(2):
        found = count_tokens(make_docs(rows), tokenizer_path(), cache)
        assert sorted(map(tuple, found.collect()), key=str) == expected
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    assert stored.count() == len({t or "" for _, t in rows})  # each text once, and none in the second run
    more = rows + [(500, "a new text")]
    assert count_tokens(make_docs(more), tokenizer_path(), cache).count() == len(more)
    assert spark.read.schema(CACHE_SCHEMA).parquet(cache).count() == stored.count() + 1
    # another tokenizer does not meet these counts
    other = count_tokens(make_docs(rows), tokenizer_path("word_bpe_49k.json"), cache)
    words = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    assert sorted(r.n_tokens for r in other.collect()) == sorted(
        len(words.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    assert count_tokens(make_docs([]), tokenizer_path()).collect() == []


def _check_packing(found, rows, reference, capacity):
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))]
        assert sum(n for _, n in placed) <= capacity
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        ids = reference(text) + [0]
        mine = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine))) and len(mine) == -(-len(ids) // capacity)
        assert sum(r.length for r in mine) == len(ids) and all(r.length == capacity for r in mine[1:])
        for r in mine:
            part = np.array(ids[r.start:r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    return len(bins)


def test_packing_round_trip(make_docs, reference):
    random.seed(7)
    rows = [(i, " ".join("word" for _ in range(random.randint(0, 90)))) for i in range(400)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None)]
    found = pack_documents(make_docs(rows), tokenizer_path(), 64, slack=1, group_items=60).collect()
    used = _check_packing(found, rows, reference, 64)
    assert used <= 1.02 * sum(len(reference(t)) + 1 for _, t in rows) / 64 + 2
    assert pack_documents(make_docs([]), tokenizer_path()).collect() == []


def test_repeated_rows_are_packed_each(make_docs):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (None, None)]
    found = pack_documents(make_docs(rows), tokenizer_path()).collect()
    assert len(found) == 4 and len({r.sequence_id for r in found}) == 1
    assert sorted(r.offset for r in found)[0] == 0 and sum(r.length for r in found) == 3 * 3 + 1


def test_items_too_large_to_meet_end_the_rounds(make_docs):
    pieces = cut_pieces(make_docs([(i, "w " * 40) for i in range(300)]), tokenizer_path(), 64)
    packed = pack(pieces, 64, group_items=20)
    assert packed.select("sequence_id").distinct().count() == packed.count() == pieces.count()


def test_bins_of_different_groups_meet(spark):
    """Few short items among many that fit with nothing: their bins still join."""
    rows = [(i, 50) for i in range(300)] + [(1000 + i, 30) for i in range(6)]
    pieces = spark.createDataFrame(rows, "item long, length long")
    packed = pack(pieces, 64, slack=0, group_items=20).collect()
    assert sorted(r.item for r in packed) == sorted(i for i, _ in rows)
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(bins) == 303
    assert sorted(map(sorted, bins.values())) == [[(0, 30), (30, 30)]] * 3 + [[(0, 50)]] * 300


def test_best_fit_takes_the_tightest_bin():
    placed = {item: (name, offset, fill) for item, name, offset, fill in best_fit([1, 2, 3, 4], [7, 6, 4, 3], 10)}
    assert placed == {1: (1, 0, 10), 4: (1, 7, 10), 2: (2, 0, 10), 3: (2, 6, 10)}
