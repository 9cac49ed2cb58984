"""Divergence of sources: how a source's use of its language's terms differs
from the language and from each other source.

A language keeps the terms that enough of its documents have.  The kept terms,
sorted, become minimal acyclic transducers: states with the same endings are
one state, and the outputs along a term's path add up to its ordinal, its
place among the language's terms in UTF-8 byte order.  Ranges of terms have
transducers of their own (shards), built side by side by tasks that read their
range in order; no two shards share the first eight bytes of a term, so these
tell a word's shard.  The texts are then streamed through: all words of a
slice take a step at a time, those that leave the transducer are not kept
terms, and those that end in a final state are counted by ordinal.  A pass
takes as many shards as fit ``VOCABULARY_BYTES``; a larger vocabulary takes
more passes.  Ordinals break ties between terms, and the transducers spell out
the terms of the report.

Two sources are compared over blocks of terms, as dense columns of a block, so
that a task holds ``TERMS x SOURCES`` numbers; terms that neither has are one
product.

Defined results: null text, lang and source are ''; a term counts once a
document for the threshold, each time for the counts; a repeated row is
another document; groups without terms are compared like others; a language
without kept terms has pairs of value 0 and no terms; values that tie are
ranked by item in UTF-8 byte order; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.phrases import encode, slice_of, strings, summed
from riskspark.llm.shared import batch_slices, lower_bytes, split_words, stage, text_bytes

SLICE_BYTES = 8 << 20  # more at once gives fewer partial counts
SHARD_TERMS = 20_000
VOCABULARY_BYTES = 64 << 20  # of the transducers that a pass over the texts takes
TERMS, SOURCES = 1024, 128  # of one block of the comparison
SCALE, PRIOR = 1_000_000_000, 5

_BREAK = np.ones(256, bool)
_BREAK[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


# ------------------------------------------------------------- transducers

class Transducer:
    """States numbered from 0 (the start); transitions sorted by (state, byte),
    each with its target and what it adds to the ordinal.  ``ways`` counts the
    terms that a state still leads to."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, adds: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.adds, self.final = keys, targets, adds, final

    @classmethod
    def of_sorted(cls, terms: Iterable[bytes]) -> Transducer:
        """From ascending distinct terms.  The open states lie along the last
        term; when the next one leaves that path, the states beyond are closed,
        and one that equals an earlier state becomes that state."""
        closed: dict[tuple, int] = {}
        opened, previous = [[False, []]], b""

        def close(depth: int) -> None:
            while len(opened) - 1 > depth:
                final, edges = opened.pop()
                state = closed.setdefault((final, tuple(edges)), len(closed))
                opened[-1][1].append((previous[len(opened) - 1], state))

        for term in terms:
            shared = 0
            while shared < min(len(term), len(previous)) and term[shared] == previous[shared]:
                shared += 1
            close(shared)
            opened.extend([False, []] for _ in term[shared:])
            opened[-1][0] = True
            previous = term
        close(0)
        closed_start = closed.setdefault((opened[0][0], tuple(opened[0][1])), len(closed))
        # a state closes after those it leads to: number them from the start down
        last = len(closed) - 1
        assert closed_start == last
        ways, final, edges = np.zeros(len(closed), np.int64), np.zeros(len(closed), bool), []
        for (is_final, out), state in closed.items():
            passed = int(is_final)
            for byte, target in out:
                edges.append(((last - state) << 8 | byte, last - target, passed))
                passed += ways[target]
            ways[state], final[last - state] = passed, is_final
        keys, targets, adds = (np.array(x, np.int64) for x in zip(*sorted(edges))) if edges else (np.zeros(0, np.int64),) * 3
        return cls(keys, targets, adds, final)

    def to_bytes(self) -> tuple[bytes, ...]:
        return tuple(x.tobytes() for x in (self.keys, self.targets, self.adds, self.final))

    @classmethod
    def from_bytes(cls, keys: bytes, targets: bytes, adds: bytes, final: bytes) -> Transducer:
        return cls(*(np.frombuffer(x, np.int64) for x in (keys, targets, adds)), np.frombuffer(final, bool))

    @classmethod
    def side_by_side(cls, some: list[Transducer]) -> tuple[Transducer, np.ndarray]:
        """One table of states for all, and where each one's start is."""
        starts = np.concatenate([[0], np.cumsum([len(t.final) for t in some])]).astype(np.int64)
        join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
        return cls(join([t.keys + (at << 8) for t, at in zip(some, starts)], np.int64),
                   join([t.targets + at for t, at in zip(some, starts)], np.int64),
                   join([t.adds for t in some], np.int64), join([t.final for t in some], bool)), starts[:-1]

    def ordinals(self, raw: np.ndarray, first: np.ndarray, last: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Of the words raw[first:last], each from its start state; -1 if
        that doesn't have it."""
        found = np.full(len(first), -1, np.int64)
        word, state, total, at = np.arange(len(first)), start.astype(np.int64), np.zeros(len(first), np.int64), first
        while len(word):
            ended = at == last[word]
            if ended.any():
                done = ended & self.final[state]
                found[word[done]] = total[done]
                word, state, total, at = (x[~ended] for x in (word, state, total, at))
            if not len(self.keys):
                break
            key = (state << 8) | raw[at]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[edge] == key
            edge = edge[goes]
            word, at = word[goes], at[goes] + 1
            state, total = self.targets[edge], total[goes] + self.adds[edge]
        return found

    def term(self, ordinal: int, start: int = 0) -> bytes:
        """The term of an ordinal: at each state the last transition that
        doesn't add more than what is left."""
        spelt, state = bytearray(), start
        while not (self.final[state] and ordinal == 0):
            low, high = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            edge = low + int(np.searchsorted(self.adds[low:high], ordinal, "right")) - 1
            spelt.append(int(self.keys[edge]) & 0xFF)
            ordinal -= int(self.adds[edge])
            state = int(self.targets[edge])
        return bytes(spelt)


def _front(term: bytes) -> int:
    """The first eight bytes as a number; terms have no zero bytes."""
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


def _fronts(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    out = np.zeros(len(first), np.uint64)
    for k in range(8):
        has = first + k < last
        out[has] |= raw[first[has] + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def build_shards(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """Transducers of ranges of the kept (lang, term): ``lang, low, n, base``
    (first eight bytes, terms, ordinal of the first), and their arrays."""
    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lang, terms = None, []

        def done() -> pa.RecordBatch:
            arrays = Transducer.of_sorted(terms).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([terms[0][:8].ljust(8, b"\0")]), pa.array([len(terms)], pa.int64()),
                 *(pa.array([x], pa.binary()) for x in arrays)], ["lang", "low", "n", "keys", "targets", "adds", "final"])

        for batch in batches:
            for of, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
                term = term.encode()
                if terms and (of != lang or (len(terms) >= shard_terms and _front(term) != _front(terms[-1]))):
                    yield done()
                    terms = []
                lang = of
                terms.append(term)
        if terms:
            yield done()

    ranged = kept.withColumn("front", F.substring(F.col("term").cast("binary"), 1, 8)).repartitionByRange(
        "lang", "front").sortWithinPartitions("lang", "term").select("lang", "term")
    shards = stage(ranged.mapInArrow(
        build, "lang string, low binary, n long, keys binary, targets binary, adds binary, final binary"), "divergence-shards")
    before = Window.partitionBy("lang").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("lang", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return shards.join(bases, ["lang", "low"])


class Vocabulary:
    """The shards of a pass, by language."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["lang", "low"], key=lambda c: c.map(lambda x: x.encode() if isinstance(x, str) else bytes(x)))
        some = [Transducer.from_bytes(*map(bytes, x)) for x in rows[["keys", "targets", "adds", "final"]].itertuples(index=False)]
        self.table, starts = Transducer.side_by_side(some)
        self.langs: dict[str, tuple[np.ndarray, ...]] = {}
        for lang, at in rows.reset_index(drop=True).groupby("lang").indices.items():
            low = np.array([int.from_bytes(bytes(x), "big") for x in rows["low"].iloc[at]], np.uint64)
            self.langs[lang] = low, starts[at], rows["base"].to_numpy(np.int64)[at], rows["n"].to_numpy(np.int64)[at]

    def ordinals(self, lang: str, raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        if lang not in self.langs:
            return np.full(len(first), -1, np.int64)
        low, starts, bases, _ = self.langs[lang]
        shard = np.zeros(len(first), np.int64)
        if len(low) > 1:
            shard = np.maximum(np.searchsorted(low, _fronts(raw, first, last), "right") - 1, 0)
        found = self.table.ordinals(raw, first, last, starts[shard])
        return np.where(found >= 0, found + bases[shard], -1)

    def term(self, lang: str, ordinal: int) -> str | None:
        """None if another pass has it."""
        low, starts, bases, counts = self.langs.get(lang, ((), (), np.zeros(0, np.int64), ()))
        shard = int(np.searchsorted(bases, ordinal, "right")) - 1
        if shard < 0 or ordinal >= bases[shard] + counts[shard]:
            return None
        return self.table.term(ordinal - int(bases[shard]), int(starts[shard])).decode()


def vocabularies(shards: DataFrame, most_bytes: int = VOCABULARY_BYTES) -> Iterator:
    """Broadcast vocabularies of at most ``most_bytes`` (or one shard) each.
    The driver sees a line a shard and the shards of one pass."""
    spark = shards.sparkSession
    size = sum((F.length(c) for c in ("keys", "targets", "adds", "final")), F.lit(0))
    lines = shards.select("lang", "low", size.alias("size")).orderBy("lang", "low").collect()
    passes, room = [], 0
    for line in lines:
        if not passes or room < line.size:
            passes.append([])
            room = most_bytes
        passes[-1].append((line.lang, bytes(line.low)))
        room -= line.size
    for some in passes:
        wanted = spark.createDataFrame([(lang, bytearray(low)) for lang, low in some], "lang string, low binary")
        yield spark.sparkContext.broadcast(Vocabulary(shards.join(F.broadcast(wanted), ["lang", "low"]).toPandas()))


# ------------------------------------------------------------- counts

def document_frequencies(docs: DataFrame) -> DataFrame:
    """``lang, term, documents`` of every term."""
    def emit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            raw, starts = text_bytes(batch.column("text"))
            lang, langs = encode(batch.column("lang"))
            for row, end in batch_slices(starts, SLICE_BYTES):
                part, part_starts = slice_of(raw, starts, row, end)
                first, last, rows = split_words(part, part_starts, _BREAK)
                if not len(first):
                    continue
                code, terms = encode(strings(lower_bytes(part), first, last))
                of = np.repeat(np.arange(row, end), np.diff(rows))
                seen = np.unique(of * len(terms) + code)  # a term once a document
                pair, n = np.unique(lang[seen // len(terms)].astype(np.int64) * len(terms) + seen % len(terms), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(pair // len(terms))), terms.take(pa.array(pair % len(terms))).cast(pa.string()),
                     pa.array(n)], ["lang", "term", "documents"])

    counted = docs.select("lang", "text").mapInArrow(emit, "lang string, term string, documents long")
    return counted.groupBy("lang", "term").agg(F.sum("documents").alias("documents"))


def recount(docs: DataFrame, vocabulary) -> DataFrame:
    """``lang, source, ordinal, n``: the texts streamed through a vocabulary."""
    def emit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = vocabulary.value
        for batch in batches:
            raw, starts = text_bytes(batch.column("text"))
            (lang, langs), (source, sources) = encode(batch.column("lang")), encode(batch.column("source"))
            found: list[list] = [[] for _ in range(len(langs))]  # partial counts of the batch, by language
            for row, end in batch_slices(starts, SLICE_BYTES):
                part, part_starts = slice_of(raw, starts, row, end)
                first, last, rows = split_words(part, part_starts, _BREAK)
                part, of = lower_bytes(part), np.repeat(np.arange(row, end), np.diff(rows))
                for code, name in enumerate(langs.to_pylist()):
                    mine = np.flatnonzero(lang[of] == code)
                    ordinal = known.ordinals(name, part, first[mine], last[mine])
                    kept = ordinal >= 0
                    found[code].append(np.unique((source[of[mine[kept]]].astype(np.int64) << 40) | ordinal[kept], return_counts=True))
            for code, parts in enumerate(found):
                keys, n = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
                if len(keys):
                    one, n = summed(keys, n)
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(np.full(len(one), code))), sources.take(pa.array(keys[one] >> 40)),
                         pa.array(keys[one] & ((1 << 40) - 1)), pa.array(n)], ["lang", "source", "ordinal", "n"])

    return docs.select("lang", "source", "text").mapInArrow(emit, "lang string, source string, ordinal long, n long")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), exactly."""
    big = ((n + PRIOR).cast("decimal(19,0)") * F.lit(SCALE)).cast("decimal(38,0)")
    whole = F.call_function("div", big, (total + PRIOR * terms).cast("decimal(38,0)"))
    return F.when(terms > 0, whole + 1)


def compare_sources(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for a, b of different numbers in one language:
    the shares' absolute differences, summed over all kept terms."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS)).cast("long")
    base = groups.select("lang", "number", "sources", F.lit(-1).cast("long").alias("ordinal"), F.col("least").alias("p"), "terms",
                         F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    rows = counts.select("lang", "number", "sources", "ordinal", "p", "terms",
                         F.floor(F.col("ordinal") / TERMS).alias("block")).unionByName(base)
    mine = F.floor(F.col("number") / SOURCES)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("sources") - 1) / SOURCES)))
    rows = rows.withColumn("mine", mine).withColumn("other", other).select(
        "lang", "number", "ordinal", "p", "terms", "block",
        F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        lang, block, low, high = pdf[["lang", "block", "low", "high"]].iloc[0]
        base, had = pdf[pdf["ordinal"] < 0].sort_values("number"), pdf[pdf["ordinal"] >= 0]
        size = int(min(TERMS, max(0, pdf["terms"].iloc[0] - block * TERMS)))
        numbers, least = base["number"].to_numpy(np.int64), base["p"].fillna(0).to_numpy(np.int64)
        ordinals, row = np.unique(had["ordinal"].to_numpy(np.int64), return_inverse=True)
        p = np.tile(least, (len(ordinals), 1))
        p[row, np.searchsorted(numbers, had["number"].to_numpy(np.int64))] = had["p"].to_numpy(np.int64)
        left, right = np.flatnonzero(numbers // SOURCES == low), np.flatnonzero(numbers // SOURCES == high)
        out = []
        for i in left:
            others = right[right > i] if low == high else right
            value = np.abs(p[:, others] - p[:, [i]]).sum(0) + (size - len(ordinals)) * np.abs(least[others] - least[i])
            out.append(pd.DataFrame({"lang": lang, "a": numbers[i], "b": numbers[others], "value": value}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})

    cells = rows.groupBy("lang", "block", "low", "high").applyInPandas(cell, "lang string, a long, b long, value long")
    return cells.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      least_documents: int = 30, top_terms: int = 50, shard_terms: int = SHARD_TERMS,
                      vocabulary_bytes: int = VOCABULARY_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` compares a
    source with each other one of its language, part ``term`` lists the terms
    that it uses more than its language does."""
    spark = docs.sparkSession
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in (
        (text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    kept = stage(document_frequencies(docs).filter(F.col("documents") >= least_documents).select("lang", "term"), "divergence-terms")
    shards = stage(build_shards(kept, shard_terms), "divergence-transducers")
    passes = list(vocabularies(shards, vocabulary_bytes))
    counts = spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    for vocabulary in passes:
        counts = counts.unionByName(recount(docs, vocabulary))
    counts = stage(counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "divergence-counts")

    of_lang = Window.partitionBy("lang")
    groups = docs.select("lang", "source").distinct().join(
        counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang", "left").fillna(0, ["total", "terms"])
    groups = groups.withColumn("least", _share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).withColumn(
        "number", F.row_number().over(of_lang.orderBy("source")).cast("long") - 1).withColumn(
        "sources", F.count(F.lit(1)).over(of_lang)).withColumn("lang_total", F.sum("total").over(of_lang))
    groups = stage(groups, "divergence-groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    apart = compare_sources(shares, groups)
    both = apart.unionByName(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda number, as_name: groups.select("lang", F.col("number").alias(number), F.col("source").alias(as_name))
    pairs = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank"))

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    over = shares.join(whole, ["lang", "ordinal"]).withColumn(
        "value", F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).filter("value > 0")
    ranked = over.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ordinal"))).filter(F.col("rank") <= top_terms)
    ranked = stage(ranked.select("lang", "source", "ordinal", "value", "rank"), "divergence-ranked")

    def spell(vocabulary):
        def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                pdf["item"] = [vocabulary.value.term(x, int(o)) for x, o in zip(pdf["lang"], pdf["ordinal"], strict=True)]
                yield pdf[pdf["item"].notna()][["lang", "source", "item", "value", "rank"]]
        return rows

    out = pairs
    for vocabulary in passes:
        spelt = ranked.mapInPandas(spell(vocabulary), "lang string, source string, item string, value long, rank int")
        out = out.unionByName(spelt.withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")
