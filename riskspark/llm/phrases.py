"""Phrase collocations of each language, by prefix-free parsing.

A text is lower-cased (A-Z), cut into pieces at punctuation and line ends,
and pieces into words.  Some words, told by their content alone, are
triggers: each starts a chunk, which ends before the next trigger or with its
piece and then overlaps by ``longest - 1`` words into what follows.  Repeated
passages are so cut into the same chunks wherever they stand.  The distinct
chunks of a language, with the number of times the parse uses them, are the
dictionary, which is written once; n-grams are counted inside distinct
chunks, weighted by that number.  An n-gram belongs to the chunk in whose own
words it starts, so what lies in an overlap is counted once.

Counting goes by length.  A phrase is at most as frequent as the parts it has,
so word pairs are counted where both words are frequent, and triples where
both pairs are.  Tasks ask a bit filter of fixed size which parts are
frequent; its errors only let more rows through to the exact counts.  A word
is a 64-bit id made of its language and itself, a phrase the row of its
words' ids; the vocabulary is searched for ids that stand for two words, and
if there are any all is counted again with other ids.

Defined results: a null text is empty, a null language is ``und``; of phrases
of equal score the more frequent comes first, then the smaller in UTF-8 byte
order; rows that are repeated count each time; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.shared import batch_slices, hash_words, lower_bytes, mix64, split_words, stage, text_bytes

SLICE_BYTES = 2 << 20
TRIGGER_ONE_IN = 16  # words, on average, between triggers
FILTER_BITS = 1 << 27  # of a filter of frequent parts: 16 MB, whatever the corpus
PAGE_BITS = 32768  # of one bitmap that Spark aggregates

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True


def slice_of(raw: np.ndarray, starts: np.ndarray, row: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    return raw[starts[row]:starts[end]], starts[row:end + 1] - starts[row]


def strings(raw: np.ndarray, first: np.ndarray, last: np.ndarray):
    """The byte ranges as an Arrow string column."""
    import pyarrow as pa

    bounds = np.concatenate([[0], np.cumsum(last - first)])
    at = np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], last - first)
    return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(raw[at]))


def encode(column) -> tuple[np.ndarray, np.ndarray]:
    """Codes of an Arrow string column, and the distinct values."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def parse(raw: np.ndarray, starts: np.ndarray, overlap: int) -> tuple[np.ndarray, ...]:
    """The chunks of lower-cased texts: row, own words, first byte, last byte."""
    first, last, rows = split_words(raw, starts, _BLANK | _CUT)
    n = len(first)
    if not n:
        return (np.zeros(0, np.int64),) * 4
    ends_piece = np.zeros(n + 1, bool)
    ends_piece[rows] = True  # a row's first word
    cuts = np.concatenate([[0], np.cumsum(_CUT[raw])])
    ends_piece[1:n] |= cuts[first[1:]] != cuts[last[:-1]]
    seen = (raw[first].astype(np.uint64) << np.uint64(40)) | (raw[last - 1].astype(np.uint64) << np.uint64(32))
    trigger = mix64(seen | (last - first).astype(np.uint64)) % np.uint64(TRIGGER_ONE_IN) == 0
    begin = np.flatnonzero(ends_piece[:-1] | trigger)
    end = np.append(begin[1:], n)
    piece_ends = np.append(np.flatnonzero(ends_piece[1:n]) + 1, n)
    reach = np.minimum(end + overlap, piece_ends[np.searchsorted(piece_ends, begin, "right")])
    return np.searchsorted(rows, begin, "right") - 1, end - begin, first[begin], last[reach - 1]


def build_dictionary(docs: DataFrame, overlap: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, own, chunk, times``: the distinct chunks and how often each is used."""
    def chunks(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            raw, starts = text_bytes(batch.column("text"))
            for row, end in batch_slices(starts, SLICE_BYTES):
                part, part_starts = slice_of(raw, starts, row, end)
                part = lower_bytes(part)
                of, own, first, last = parse(part, part_starts, overlap)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").take(pa.array(of + row)), pa.array(own.astype(np.int32)),
                     strings(part, first, last).cast(pa.string())], ["lang", "own", "chunk"])

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(chunks, "lang string, own int, chunk string")
    return stage(rows.groupBy("lang", "own", "chunk").agg(F.count(F.lit(1)).alias("times")), "phrase-chunks")


def _lang_hashes(langs, seed: int) -> np.ndarray:
    named = [hashlib.blake2b(x.encode(), digest_size=8, key=seed.to_bytes(8, "little")).digest() for x in langs.to_pylist()]
    return np.frombuffer(b"".join(named), np.uint64)


def _read(batch, seed: int) -> Iterator[tuple]:
    """Of slices of the dictionary: language code, id and chunk of each word,
    whether it is one of its chunk's own, the chunks' times, distinct words
    and their codes, languages."""
    raw, starts = text_bytes(batch.column("chunk"))
    own, times = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("own", "times"))
    lang, langs = encode(batch.column("lang"))
    hashes = _lang_hashes(langs, seed)
    for row, end in batch_slices(starts, SLICE_BYTES):
        part, part_starts = slice_of(raw, starts, row, end)
        first, last, rows = split_words(part, part_starts, _BLANK)
        if not len(first):
            continue
        code, words = encode(strings(part, first, last))
        word_raw, word_starts = text_bytes(words)
        chunk = np.repeat(np.arange(row, end), np.diff(rows))
        ids = mix64(hash_words(word_raw, word_starts[:-1], word_starts[1:])[code] ^ hashes[lang[chunk]])
        mine = np.arange(len(first)) - np.repeat(rows[:-1], np.diff(rows)) < own[chunk]
        yield lang[chunk], ids.view(np.int64), chunk, mine, times, words, code, langs


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return order[begin], np.add.reduceat(weights[order], begin)


def count_words(dictionary: DataFrame) -> tuple[DataFrame, int]:
    """``id, lang, word, n``, and the seed with which no id has two words."""
    def emit(batches: Iterator, seed: int) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lang, ids, chunk, mine, times, words, code, langs in _read(batch, seed):
                at = np.flatnonzero(mine)
                one, n = summed(lang[at].astype(np.int64) * len(words) + code[at], times[chunk[at]])
                at = at[one]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), langs.take(pa.array(lang[at])),
                     words.take(pa.array(code[at])).cast(pa.string()), pa.array(n)], ["id", "lang", "word", "n"])

    seed = 0
    while True:
        rows = dictionary.mapInArrow(lambda batches, seed=seed: emit(batches, seed), "id long, lang string, word string, n long")
        words = stage(rows.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            return words, seed
        seed += 1


def _pair_key(one, two):
    """Of a pair's ids, alike in Spark and numpy; ids are hashes already."""
    if isinstance(one, Column):
        return one.bitwiseXOR(F.shiftleft(two, 1).bitwiseOR(F.shiftrightunsigned(two, 63)))
    turned = two.view(np.uint64)
    return one ^ ((turned << np.uint64(1)) | (turned >> np.uint64(63))).view(np.int64)


def part_filter(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A bit for each key's remainder: pages that Spark aggregates, at most
    ``bits`` in all however many keys there are."""
    at = F.pmod(key, F.lit(bits))
    pages = keys.select(F.floor(at / PAGE_BITS).cast("int").alias("page"), (at % PAGE_BITS).alias("bit")).groupBy(
        "page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    found = np.zeros(-(-bits // PAGE_BITS) * PAGE_BITS // 8, np.uint8)
    for row in pages.collect():  # at most bits / PAGE_BITS rows of 4 KB
        found[row.page * PAGE_BITS // 8:(row.page + 1) * PAGE_BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)
    return found


def _has(found: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    at = np.mod(keys, bits)
    return (found[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def count_phrases(dictionary: DataFrame, size: int, parts: DataFrame, key: Column, seed: int, least: int,
                  bits: int) -> DataFrame:
    """``w1 .. w<size>, a``: phrases of ``size`` words that occur ``least``
    times; ``parts`` are the frequent phrases a word shorter."""
    found = dictionary.sparkSession.sparkContext.broadcast(part_filter(parts, key, bits))
    names = [f"w{k + 1}" for k in range(size)]

    def emit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for _, ids, chunk, mine, times, *_ in _read(batch, seed):
                known = _has(found.value, ids if size == 2 else _pair_key(ids[:-1], ids[1:]), bits)
                there = len(ids) - size + 1
                if there <= 0:
                    continue
                at = np.flatnonzero(mine[:there] & (chunk[:there] == chunk[size - 1:]) & known[:there] & known[1:there + 1])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(ids[at + k]) for k in range(size)), pa.array(times[chunk[at]])], [*names, "a"])

    rows = dictionary.mapInArrow(emit, ", ".join(f"{x} long" for x in [*names, "a"]))
    counted = rows.groupBy(*names).agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    return stage(counted, f"phrases-{size}")


def _score(a: str, left: str, right: str) -> Column:
    exact = [f"cast({x} as decimal(19, 0))" for x in (a, left, right)]
    return F.expr(f"(1000000BD * {exact[0]} * {exact[0]}) div ({exact[1]} * {exact[2]})")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, top: int = 2000,
                 covered_percent: int = 50, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top``
    phrases of two and three words."""
    dictionary = build_dictionary(docs, 2, text_col, lang_col)
    words, seed = count_words(dictionary)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    common = words.filter(F.col("n") >= least)
    pairs = count_phrases(dictionary, 2, common, F.col("id"), seed, least, filter_bits)
    triples = count_phrases(dictionary, 3, pairs, _pair_key(F.col("w1"), F.col("w2")), seed, least, filter_bits)

    def word(k: int) -> DataFrame:
        return common.select(F.col("id").alias(f"w{k}"), F.col("lang").alias(f"lang{k}"),
                             F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"))

    def pair(one: str, two: str, name: str) -> DataFrame:
        return pairs.select(F.col("w1").alias(one), F.col("w2").alias(two), F.col("a").alias(name))

    # a pair inside a triple that has a good part of its occurrences goes
    inside = triples.select("w1", "w2", "a").unionByName(
        triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    kept = pairs.join(inside, ["w1", "w2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a")))
    twos = kept.join(word(1), "w1").join(word(2), "w2").select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "word1", "word2").alias("phrase"), "a",
        F.col("n1").alias("l"), F.col("n2").alias("r"), _score("a", "n1", "n2").alias("score"))
    threes = triples.join(pair("w1", "w2", "front"), ["w1", "w2"]).join(pair("w2", "w3", "back"), ["w2", "w3"]).join(
        word(1), "w1").join(word(2).drop("lang2", "n2"), "w2").join(word(3).drop("lang3"), "w3").select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
        "n1", "back", "front", "n3", _score("a", "n1", "back").alias("s1"), _score("a", "front", "n3").alias("s2"))
    after_one = F.col("s1") <= F.col("s2")
    threes = threes.select(
        "lang", "phrase", "a", F.when(after_one, F.col("n1")).otherwise(F.col("front")).alias("l"),
        F.when(after_one, F.col("back")).otherwise(F.col("n3")).alias("r"), F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = twos.unionByName(threes).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
