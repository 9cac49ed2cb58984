"""Quality scores by a sparse rule ensemble.

1. Statistics of each whole text (shares of character classes, word and line
   shape, repetition), computed on Arrow batches and kept as a stage.
2. Shallow trees are grown on labelled rows; every path from a root to a node
   is a rule: a conjunction of bounds on statistics.
3. A lasso logistic regression weighs the rules and drops most of them.
4. The rules that stay are compiled to one Spark column expression, which
   scores all rows inside Spark.

Training uses at most ``train_rows`` labelled rows (all, if fewer), drawn by
a digest of the id.

Defined results: a null text is an empty text, whose statistics are all 0; a
text scores by its statistics alone, so equal texts score alike; of several
labels of one id the smallest counts; without labels of both kinds every
score is the share of label 1 (0.5 without labels); repeated and null ids are
rows like others (a null id has no label); other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.shared import batch_slices, hash_words, lower_bytes, mix64, split_words, stage, text_bytes

STATISTICS = ["log_words", "word_length", "upper", "digit", "symbol", "stop", "space", "wide", "pipe",
              "distinct_words", "top_word", "repeats_previous", "distinct_pairs", "line_length", "repeated_lines",
              "lines_end_open", "capital_words", "symbol_words"]
SLICE_BYTES = 2 << 20


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class("0123456789")
_STOP = _class(".,;:?'\"-")
_SYMBOL = _class("!#$%&*+/<=>@[\\]^_`{|}~")
_BLANK = _class(" \t\n\v\f\r")


def _row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[starts[1:]] - total[starts[:-1]]).astype(float)


def _spread(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the keys of each row (rows: first key of each, with the total):
    how many differ, and how often the commonest occurs."""
    n = len(rows) - 1
    row = np.repeat(np.arange(n), np.diff(rows))
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.concatenate([at, [len(k)]]))
    most = np.zeros(n)
    np.maximum.at(most, r[at], runs)
    return np.bincount(r[at], minlength=n).astype(float), most


def statistics(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows x STATISTICS, for the texts in ``raw``."""
    n, size = len(starts) - 1, np.diff(starts).astype(float)
    per_byte = lambda mask: _row_sums(mask, starts) / np.maximum(size, 1)
    first, last, rows = split_words(raw, starts)
    words = np.diff(rows).astype(float)
    row_of = np.repeat(np.arange(n), np.diff(rows))
    per_word = lambda x: np.bincount(row_of, x, n) / np.maximum(words, 1)
    keys = hash_words(lower_bytes(raw), first, last)
    distinct, most = _spread(keys, rows)
    same = np.zeros(len(keys))
    same[1:] = (keys[1:] == keys[:-1]) & (row_of[1:] == row_of[:-1])
    pairs = np.zeros(len(keys), np.uint64)
    pairs[:-1] = mix64(keys[:-1]) + keys[1:]
    ends_row = np.zeros(len(keys), bool)
    ends_row[rows[1:][words > 0] - 1] = True
    pair_rows = np.concatenate([[0], np.cumsum(np.maximum(np.diff(rows) - 1, 0))])
    distinct_pairs, _ = _spread(pairs[~ends_row], pair_rows)
    # lines: the words between line ends, one hash a line
    newline = raw == 0x0A
    line_of_word = np.cumsum(newline)[first] if len(first) else np.zeros(0, np.int64)
    new_line = np.ones(len(first), bool)
    new_line[1:] = (line_of_word[1:] != line_of_word[:-1]) | (row_of[1:] != row_of[:-1])
    line_at = np.flatnonzero(new_line)
    place = np.arange(len(first)) - np.repeat(line_at, np.diff(np.concatenate([line_at, [len(first)]])))
    line_keys = (np.add.reduceat(mix64(keys + mix64(place.astype(np.uint64))), line_at)
                 if len(first) else np.zeros(0, np.uint64))
    line_rows = np.searchsorted(line_at, rows)
    lines = np.diff(line_rows).astype(float)
    distinct_lines, _ = _spread(line_keys, line_rows)
    line_last = np.concatenate([line_at[1:], [len(first)]]) - 1 if len(first) else line_at
    open_end = (~np.isin(raw[last[line_last] - 1], np.frombuffer(b".!?", np.uint8))).astype(float)
    line_row = np.repeat(np.arange(n), np.diff(line_rows))
    lead, tail = (raw[first], raw[last - 1]) if len(first) else (np.zeros(0, np.uint8),) * 2
    more_upper = np.zeros(len(first))
    inside = np.flatnonzero(last - first > 1)
    more_upper[inside] = _UPPER[lead[inside]] & _UPPER[raw[first[inside] + 1]]
    safe = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    return np.column_stack([
        np.log1p(words), per_word((last - first).astype(float)), per_byte(_UPPER[raw]), per_byte(_DIGIT[raw]),
        per_byte(_SYMBOL[raw]), per_byte(_STOP[raw]), per_byte(_BLANK[raw]), per_byte(raw >= 0x80),
        per_byte(raw == ord("|")), safe(distinct, words), safe(most, words), per_word(same),
        safe(distinct_pairs, np.maximum(words - 1, 0)), safe(words, lines), 1 - safe(distinct_lines, lines) - (lines == 0),
        safe(np.bincount(line_row, open_end, n), lines), per_word(more_upper), per_word(_SYMBOL[tail].astype(float))])


def text_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and one double for each of STATISTICS."""
    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            raw, starts = text_bytes(batch.column("__text"))
            parts = [statistics(raw[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                     for lo, hi in batch_slices(starts, SLICE_BYTES)]
            stats = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(x) for x in stats.T]], [*keep, *STATISTICS])

    chosen = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return chosen.mapInArrow(compute, ", ".join([*kinds, *[f"{s} double" for s in STATISTICS]]))


Rule = tuple[tuple[str, str, float], ...]


def tree_rules(root, names: list[str]) -> set[Rule]:
    """Every path from the root to a node, as its tightest bounds."""
    rules: set[Rule] = set()

    def walk(node, bounds: dict):
        if bounds:
            rules.add(tuple(sorted((name, op, value) for (name, op), value in bounds.items())))
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, value = names[split.featureIndex()], float(split.threshold())
        for child, op, tightest in ((node.leftChild(), "<=", min), (node.rightChild(), ">", max)):
            walk(child, bounds | {(name, op): tightest(bounds.get((name, op), value), value)})

    walk(root, {})
    return rules


def rule_column(rule: Rule) -> Column:
    tests = [F.col(name) <= value if op == "<=" else F.col(name) > value for name, op, value in rule]
    return functools.reduce(operator.and_, tests)


def fit_rules(train: DataFrame, trees: int = 16, depth: int = 3, lasso: float = 0.002,
              seed: int = 7) -> tuple[list[tuple[Rule, float]], float]:
    """Weighted rules and the intercept, from ``train`` (STATISTICS, label)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    vectors = train.select(array_to_vector(F.array(*STATISTICS)).alias("features"), F.col("label").cast("double"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", seed=seed).fit(vectors)
    rules = sorted(set().union(*(tree_rules(t, STATISTICS) for t in
                                 (x._call_java("rootNode") for x in forest.trees))))
    fired = train.select(
        array_to_vector(F.array(*[rule_column(r).cast("double") for r in rules])).alias("features"),
        F.col("label").cast("double"))
    fired = stage(fired, "quality-fired")
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(fired)
    weights = [(r, float(w)) for r, w in zip(rules, model.coefficients, strict=True) if w]
    return weights, float(model.intercept)


def score_column(weights: list[tuple[Rule, float]], intercept: float) -> Column:
    total = F.lit(intercept)
    for rule, weight in weights:
        total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, fold: int = 0,
                  train_rows: int = 40_000, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    stats = stage(text_statistics(docs.select("doc_id", "text"), ["doc_id"]), "quality-statistics")
    digest = F.crc32(F.col("doc_id").cast("string"))
    known = labels.filter(F.col(label_col).isNotNull() & (F.pmod(digest, F.lit(folds)) != fold)).groupBy(
        "doc_id").agg(F.min(label_col).alias("label"))
    rows = known.count()
    if rows > train_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * train_rows / rows))
    train = stage(stats.join(known, "doc_id").select(*STATISTICS, F.least(F.col("label"), F.lit(1)).alias("label")),
                  "quality-train")
    kinds = {r.label: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(kinds) >= {0, 1}:
        score = score_column(*fit_rules(train))
    else:
        score = F.lit(float(1 in kinds) if kinds else 0.5)
    scored = stats.select("doc_id", F.coalesce(F.pmod(digest, F.lit(folds)) == fold, F.lit(False)).alias("held_out"),
                          score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
