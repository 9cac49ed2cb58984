"""Language identification for mixed-language text.

A word is a run of letters.  Its script ranges (code-point ranges of its
characters) narrow the candidate languages to those that use all of them in
the training texts.  Each candidate scores the word by byte trigrams, and
Viterbi with a penalty for each switch labels the words, so that spans of
different languages in one text come out apart.  The text's language is the
one that holds most letters; its score is that language's share of them.

The model is counts of hashed trigrams by language, summed by Spark over a
sample of the labelled texts bounded by ``train_rows``; its size is set by
the number of languages and ``BUCKETS``, not by the corpus.

Defined results: a text that is null or has no letter is ``und`` with score
0, as is every text if no language could be learned; a text whose only
letters are outside the word table gets the commonest language with its share
of the training letters; equal shares go to the first language in order;
repeated and null ids are rows like others; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.shared import batch_slices, join_checked, lower_bytes, split_words, stage, text_bytes, tidy

BUCKETS = 1 << 16
SLICE_BYTES = 1 << 20  # scored at once
GROUP_BYTES = 12 << 20  # labelled at once: Viterbi steps over many texts in parallel
SWITCH_PENALTY = 12.0
#: First code point of each range of letters; a word's ranges narrow its languages.
SCRIPT_STARTS = np.array([0x0, 0x80, 0x100, 0x250, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xA00,
                          0xB80, 0xE00, 0x10A0, 0x1100, 0x1E00, 0x2C00, 0x3040, 0x30A0, 0x3100, 0x3400, 0xAC00,
                          0xD7B0, 0x10000])
SCRIPT_SHARE = 0.002  # of a language's words that must use a range for it to be the language's

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages: centred log probabilities
    scripts: np.ndarray  # script ranges x languages: whether the language uses the range
    share: np.ndarray  # of the training letters


def _prepare(raw: np.ndarray, starts: np.ndarray):
    """Lower-cased bytes with everything but letters blanked; the words; the
    letters' places; a bit set of script ranges for each word."""
    b = lower_bytes(raw)
    before = np.zeros_like(b)
    before[1:] = b[:-1]
    upper = (before == 0xC3) & (b >= 0x80) & (b <= 0x9E) & (b != 0x97)  # Latin-1 capitals
    b[upper] += 0x20
    # punctuation and symbols of several bytes
    after = np.zeros_like(b)
    after[:-1] = b[1:]
    blank = b == 0xC2
    wide = ((b == 0xE2) & (after < 0xB0)) | ((b == 0xE3) & (after == 0x80))
    emoji = (b == 0xF0) & (after == 0x9F)
    for mark, length in ((blank, 2), (wide, 3), (emoji, 4)):
        at = np.flatnonzero(mark)
        for k in range(length):
            b[np.minimum(at + k, len(b) - 1)] = 0x20
    letters = _LETTER[b]
    b[~letters] = 0x20
    first, last, rows = split_words(b, starts, ~_LETTER)
    return b, letters, first, last, rows


def _grams(b: np.ndarray, starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bucket of the trigram centred on each place; rows end in blanks."""
    left = np.full(len(b), 0x20, np.uint32)
    left[1:] = b[:-1]
    right = np.full(len(b), 0x20, np.uint32)
    right[:-1] = b[1:]
    inner = starts[(starts > 0) & (starts < len(b))]
    left[inner] = 0x20
    right[inner - 1] = 0x20
    gram = (left[at] << np.uint32(16)) | (b[at].astype(np.uint32) << np.uint32(8)) | right[at]
    return (gram * np.uint32(0x9E3779B1)) >> np.uint32(16)


def _scripts(b: np.ndarray, first: np.ndarray, letters_at: np.ndarray, word_begin: np.ndarray) -> np.ndarray:
    """Bit set of the script ranges of each word."""
    lead = b[letters_at]
    point = np.zeros(len(letters_at), np.int64)
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        p = letters_at[wide]
        nxt = lambda k: (b[np.minimum(p + k, len(b) - 1)] & 0x3F).astype(np.int64)
        head = lead[wide].astype(np.int64)
        point[wide] = np.where(
            head < 0xE0, ((head & 0x1F) << 6) | nxt(1),
            np.where(head < 0xF0, ((head & 0xF) << 12) | (nxt(1) << 6) | nxt(2),
                     ((head & 0x7) << 18) | (nxt(1) << 12) | (nxt(2) << 6) | nxt(3)))
    bits = np.left_shift(1, np.searchsorted(SCRIPT_STARTS, point, "right") - 1)
    # continuation bytes say nothing; ASCII letters say range 0
    bits[(lead >= 0x80) & (lead < 0xC0)] = 0
    return np.bitwise_or.reduceat(bits, word_begin) if len(first) else np.zeros(0, np.int64)


def _words(raw: np.ndarray, starts: np.ndarray):
    b, letters, first, last, rows = _prepare(raw, starts)
    at = np.flatnonzero(letters)
    lengths = last - first
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(first) else first
    return _grams(b, starts, at), _scripts(b, first, at, begin), first, lengths, begin, rows


def train_language_model(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                         train_rows: int = 50_000) -> LanguageModel:
    """``labelled`` rows with a language; about ``train_rows`` of them (all,
    if fewer), drawn by a digest of the text, are used."""
    texts = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    known = texts.count()
    if known > train_rows:
        texts = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * train_rows / known))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            raw, starts = text_bytes(batch.column("text"))
            for lo, hi in batch_slices(starts, SLICE_BYTES):
                part = starts[lo:hi + 1] - starts[lo]
                gram, bits, _, lengths, begin, rows = _words(raw[starts[lo]:starts[hi]], part)
                ends = np.concatenate([begin, [len(gram)]])
                for i in range(hi - lo):
                    lang, (w0, w1) = langs[lo + i], rows[i:i + 2]
                    if w0 == w1:
                        continue
                    got = grams.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    got += np.bincount(gram[ends[w0]:ends[w1]], minlength=BUCKETS)
                    used = scripts.setdefault(lang, np.zeros(len(SCRIPT_STARTS) + 1, np.int64))
                    used[-1] += w1 - w0
                    for s in range(len(SCRIPT_STARTS)):
                        used[s] += np.count_nonzero(bits[w0:w1] >> s & 1)
        for lang, got in grams.items():
            some = np.flatnonzero(got)
            used = np.flatnonzero(scripts[lang])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(some) + len(used)), pa.string()),
                 pa.array(np.concatenate([some, BUCKETS + used]).astype(np.int32)),
                 pa.array(np.concatenate([got[some], scripts[lang][used]]))], ["lang", "bucket", "n"])

    counts = (texts.mapInArrow(tidy(count), "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counts["lang"].unique())
    full = np.zeros((BUCKETS + len(SCRIPT_STARTS) + 1, len(languages)))
    full[counts["bucket"], counts["lang"].map({x: i for i, x in enumerate(languages)}).astype(int)] = counts["n"]
    grams, scripts, words = full[:BUCKETS], full[BUCKETS:-1], full[-1]
    if not languages:
        return LanguageModel([], grams, scripts.astype(bool), np.zeros(0))
    table = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS))
    table = (table - table.mean(1, keepdims=True)).astype(np.float32)
    return LanguageModel(languages, table, scripts >= SCRIPT_SHARE * words, grams.sum(0) / grams.sum())


def viterbi(scores: np.ndarray, rows: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each word, for all texts at once.  ``rows``: first word
    of each text, with the total appended.  Texts are stepped in parallel,
    the longest first, so each step works on a leading slice."""
    kind = np.min_scalar_type(-max(scores.shape[1], 1))  # wide enough for every label
    labels = np.zeros(len(scores), kind)
    if not len(scores):
        return labels
    lengths = np.diff(rows)
    order = np.argsort(-lengths, kind="stable")
    begin, length = rows[:-1][order], lengths[order]
    n_langs = scores.shape[1]
    came = np.zeros(scores.shape, kind)
    own = np.arange(n_langs, dtype=kind)
    alive = np.searchsorted(-length, -np.arange(length[0]), "left")  # texts with a word at each step
    v = scores[begin[:alive[0]]].copy()
    last = np.zeros(len(lengths), kind)
    for t in range(1, int(length[0])):
        a = alive[t]
        if a < len(v):
            last[a:len(v)] = v[a:].argmax(1)
            v = v[:a]
        at = begin[:a] + t
        v = v - v.max(1, keepdims=True)
        best = v.argmax(1).astype(kind)
        came[at] = np.where(v >= -penalty, own, best[:, None])
        v = np.maximum(v, -penalty) + scores[at]
    last[:len(v)] = v.argmax(1)
    for t in range(int(length[0]) - 1, -1, -1):
        a = alive[t]
        at = begin[:a] + t
        labels[at] = last[:a]
        if t:
            last[:a] = came[at, last[:a]]
    return labels


def _label_group(column, model: LanguageModel, penalty: float):
    """Languages, scores and spans (count of each text; start, end, label) of
    an Arrow string column."""
    raw, starts = text_bytes(column)
    n, k = len(column), len(model.languages)
    scores, sizes, begins, counts = [], [], [], []
    for lo, hi in batch_slices(starts, SLICE_BYTES):
        part = starts[lo:hi + 1] - starts[lo]
        gram, bits, first, lengths, begin, rows = _words(raw[starts[lo]:starts[hi]], part)
        counts.append(np.diff(rows))
        if not len(first):
            continue
        score = np.add.reduceat(model.table[gram], begin)
        fits = np.ones((len(first), k), bool)
        for s in range(len(SCRIPT_STARTS)):
            uses = (bits >> s & 1).astype(bool)
            if uses.any():
                fits[uses] &= model.scripts[s]
        worst = score.min(1, keepdims=True) - np.float32(8 * penalty)
        score = np.where(fits, score, worst)
        score[~fits.any(1)] = 0
        scores.append(score)
        sizes.append(lengths.astype(np.int32))
        begins.append(first + starts[lo])
    rows = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    scores = np.concatenate(scores) if scores else np.zeros((0, k), np.float32)
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int32)
    begins = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    labels = viterbi(scores, rows, penalty)
    del scores
    text_of = np.repeat(np.arange(n), np.diff(rows))
    held = np.bincount(text_of * k + labels, sizes, minlength=n * k).reshape(n, k)
    total = held.sum(1)
    share = np.divide(held.max(1), total, out=np.zeros(n), where=total > 0)
    names = np.array(model.languages, object)[held.argmax(1)]
    # texts without an ASCII letter: is there any letter at all?
    ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[raw] & (raw < 0x80), dtype=np.int32)])
    for i in np.flatnonzero(np.diff(ascii_letters[starts]) == 0):
        text = column[i].as_py()
        if not any(map(str.isalpha, text or "")):
            names[i], share[i] = "und", 0.0
        elif not total[i]:
            names[i], share[i] = model.languages[model.share.argmax()], float(model.share.max())
    # spans: runs of one label in one text
    change = np.ones(len(labels), bool)
    change[1:] = (labels[1:] != labels[:-1]) | (text_of[1:] != text_of[:-1])
    span = np.flatnonzero(change)
    last = np.concatenate([span[1:], [len(labels)]]) - 1 if len(span) else span
    base = starts[text_of[span]]
    return names, share, np.bincount(text_of[span], minlength=n), begins[span] - base, begins[last] + sizes[last] - base, labels[span]


def _label_batch(column, model: LanguageModel, penalty: float):
    """Arrow columns: language, score and spans of each text."""
    import pyarrow as pa

    _, starts = text_bytes(column)
    parts = [_label_group(column.slice(lo, hi - lo), model, penalty) for lo, hi in batch_slices(starts, GROUP_BYTES)]
    names, share, counts, start, end, label = (np.concatenate(x) for x in zip(*parts, strict=True))
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(start), pa.array(end),
                                    pa.array(np.array(model.languages, object)[label], pa.string())],
                                   ["start", "end", "lang"]))
    return pa.array(names, pa.string()), pa.array(share), spans


RESULT = "lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"


def label_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None,
                    penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Columns ``keep`` with ``lang_pred``, ``score`` and ``spans`` (byte
    ranges of the UTF-8 text)."""
    keep = ["doc_id"] if keep is None else keep
    if not model.languages:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("array<struct<start:long,end:long,lang:string>>").alias("spans"))
    wire = docs.sparkSession.sparkContext.broadcast(model)  # size set by languages x buckets

    def label(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            found = _label_batch(batch.column("__text"), wire.value, penalty)
            rest = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*rest, *found], [*keep, "lang_pred", "score", "spans"])

    chosen = docs.select(*keep, F.col(text_col).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(tidy(label), f"{kinds}, {RESULT}")


def held_out(id_col: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether the id's digest puts the row in the held-out fold."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(folds)) == fold, F.lit(False))


def _learned(docs: DataFrame, train_rows: int) -> LanguageModel:
    """Learned from the rows of ``docs`` that are not held out."""
    return train_language_model(docs.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1),
                                train_rows=train_rows)


def _identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    chosen = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return label_languages(chosen, model, keep=["doc_id", "held_out"])


def identify_languages(docs: DataFrame, train_rows: int = 50_000) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans``, learned from the rows of
    ``docs`` that are not held out."""
    return _identified(docs, _learned(docs, train_rows))


def keep_identified(docs: DataFrame, train_rows: int = 50_000) -> DataFrame:
    """The rows of ``docs`` in some language, or in several: rejected are
    texts without a letter, and only they: if no row has a label, nothing can
    be learned and the letters alone decide.  The rejected ids are few; rows
    whose id is null or repeated are decided by their text."""
    model = _learned(docs, train_rows)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not len(model.languages):
        return docs.filter(letters)
    found = stage(_identified(docs, model).select("doc_id", "lang_pred"), "language-result")
    bad = found.filter("lang_pred = 'und' and doc_id is not null").select("doc_id").distinct()
    vague = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1 and doc_id is not null").select("doc_id")
    vague = stage(vague, "language-vague-ids")
    rejected = stage(bad.unionByName(vague).distinct(), "language-rejected")
    clear = join_checked(docs.filter(F.col("doc_id").isNotNull()), rejected, "doc_id", "left_anti").select(docs.columns)
    unclear = docs.filter(F.col("doc_id").isNull()).unionByName(
        join_checked(docs, vague, "doc_id", "left_semi").select(docs.columns))
    return clear.unionByName(unclear.filter(letters))
