"""Toxicity by a classifier chain.

Categories are predicted in order by linear (logistic) models on the words a
text holds; each later model also takes the probabilities of the earlier
ones.  In training those are out-of-fold predictions, so that a later model
sees earlier probabilities as wrong as they will be on new text.

Features are words and word beginnings (4 to 6 bytes), hashed to 64 bits.
Those are kept that occur in ``least_texts`` toxic training texts and are at
least ``least_lift`` times as common there as overall, at most
``most_features``, by likelihood ratio.

``labels`` may hold any category columns.  The corpus has one label only, so
``weak_categories`` makes two finer ones for training texts from its lexicon
(features found almost only in toxic texts): ``insult`` (some lexicon entry)
and ``severe`` (three or more), and the given label ends the chain.

Training uses at most ``train_rows`` labelled rows (all, if fewer), drawn by
a digest of the id; the chain is fitted in one task on that bounded sample.

Defined results: a null or empty text holds no feature and scores by the
intercepts; of several labels of one id the largest counts; without labels of
both kinds all probabilities are the share of label 1 (0 without labels);
repeated and null ids are rows like others (a null id has no label); other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.language import _prepare
from riskspark.llm.shared import batch_slices, mix64, stage, text_bytes

PREFIXES = (4, 5, 6)
SLICE_BYTES = 2 << 20
_FILTER_BITS = 20


def word_features(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, whether it is a whole word) of every word and word
    beginning, repeats included."""
    b, letters, first, last, rows = _prepare(raw, starts)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    lengths = last - first
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    chars = b[np.flatnonzero(letters)]
    place = np.arange(len(chars)) - np.repeat(begin, lengths)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
        mix64((place.astype(np.uint64) << np.uint64(8)) | chars))])
    row = np.repeat(np.arange(len(starts) - 1), np.diff(rows))
    out_row, out_hash = [row], [mix64(upto[begin + lengths] - upto[begin])]
    for k in PREFIXES:
        longer = np.flatnonzero(lengths > k)
        at = begin[longer]
        out_row.append(row[longer])
        out_hash.append(mix64(upto[at + k] - upto[at] + np.uint64(k)))
    whole = np.zeros(sum(map(len, out_row)), bool)
    whole[:len(row)] = True
    return np.concatenate(out_row), np.concatenate(out_hash), whole


class FeatureTable:
    """Hashes -> places in a fixed list; most words are turned away by a bit table."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[self.hashes & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def present(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, feature) of the texts, in order."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, found, _ = word_features(raw, starts)
        maybe = np.flatnonzero(self.bits[found & np.uint64((1 << _FILTER_BITS) - 1)])
        row, found = row[maybe], found[maybe]
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hit = self.hashes[at] == found
        key = np.unique(row[hit] * len(self.hashes) + at[hit])
        return key // len(self.hashes), key % len(self.hashes)


@dataclass
class Chain:
    categories: list[str]
    features: FeatureTable
    weights: np.ndarray  # categories x features
    earlier: np.ndarray  # categories x categories: weight of an earlier probability
    intercepts: np.ndarray

    def predict(self, n: int, row: np.ndarray, feature: np.ndarray) -> np.ndarray:
        out = np.zeros((n, len(self.categories)))
        for c in range(len(self.categories)):
            logit = self.intercepts[c] + np.bincount(row, self.weights[c][feature], n) + out[:, :c] @ self.earlier[c, :c]
            out[:, c] = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
        return out


def fit_logistic(row: np.ndarray, feature: np.ndarray, dense: np.ndarray, label: np.ndarray, n_features: int,
                 ridge: float = 1e-5, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray, float]:
    """Ridge logistic regression on binary features (row, feature) and dense
    columns, by Nesterov's method with steps scaled by each column's curvature."""
    n = len(label)
    rate = np.clip(label.mean(), 1e-4, 1 - 1e-4)
    w, d, b = np.zeros(n_features), np.zeros(dense.shape[1]), float(np.log(rate / (1 - rate)))
    active = np.bincount(row, minlength=n).max() if len(row) else 0
    scale = 4.0 / (active + dense.shape[1] + 1)  # columns that are on together share a step
    curve_w = np.bincount(feature, minlength=n_features) / n + ridge
    curve_d = (dense ** 2).sum(0) / n + ridge
    last = (w, d, b)
    for t in range(rounds):
        beta = t / (t + 3)
        yw, yd, yb = (x + beta * (x - z) for x, z in zip((w, d, b), last, strict=True))
        last = (w, d, b)
        p = 1 / (1 + np.exp(-np.clip(yb + np.bincount(row, yw[feature], n) + dense @ yd, -60, 60)))
        error = (p - label) / n
        w = yw - scale * (np.bincount(feature, error[row], n_features) + ridge * yw) / curve_w
        d = yd - scale * (dense.T @ error + ridge * yd) / curve_d
        b = yb - scale * error.sum()
    return w, d, float(b)


def fit_chain(categories: list[str], features: np.ndarray, row: np.ndarray, feature: np.ndarray,
              labels: np.ndarray, folds: int = 4) -> Chain:
    """The chain on a bounded sample: ``labels`` is texts x categories,
    (row, feature) says what the texts hold."""
    n, k, m = len(labels), len(categories), len(features)
    fold = np.arange(n) % folds
    weights, earlier, intercepts = np.zeros((k, m)), np.zeros((k, k)), np.zeros(k)
    before = np.zeros((n, 0))
    for c in range(k):
        weights[c], earlier[c, :c], intercepts[c] = fit_logistic(row, feature, before, labels[:, c], m)
        if c + 1 < k:
            unseen = np.zeros(n)
            for f in range(folds):
                own = np.flatnonzero(fold != f)
                place = np.full(n, -1)
                place[own] = np.arange(len(own))
                inside = place[row] >= 0
                w, d, b = fit_logistic(place[row[inside]], feature[inside], before[own], labels[own, c], m)
                logit = b + np.bincount(row, w[feature], n) + before @ d
                unseen[fold == f] = (1 / (1 + np.exp(-np.clip(logit, -60, 60))))[fold == f]
            before = np.column_stack([before, unseen])
    return Chain(categories, FeatureTable(features), weights, earlier, intercepts)


def weak_categories(row: np.ndarray, feature: np.ndarray, label: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """insult, severe, toxic for training texts; ``whole``: features that are whole words."""
    n = len(label)
    held = np.maximum(np.bincount(feature, minlength=len(whole)), 1)
    sure = (np.bincount(feature, label[row], len(whole)) / held >= 0.9)
    entries = np.bincount(row, (sure & whole)[feature], n)
    return np.column_stack([np.minimum(label, np.bincount(row, sure[feature], n) > 0), np.minimum(label, entries > 2), label])


def select_features(train: DataFrame, least_texts: int, least_lift: float, most_features: int) -> pd.DataFrame:
    """(hash, whole) of the features kept; two passes over the bounded
    sample, the second only over candidates."""
    def hashes(table_hashes: np.ndarray | None):
        def emit(batches: Iterator) -> Iterator:
            import pyarrow as pa

            table = None if table_hashes is None else FeatureTable(table_hashes)
            for batch in batches:
                raw, starts = text_bytes(batch.column("text"))
                for lo, hi in batch_slices(starts, SLICE_BYTES):
                    part = raw[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo]
                    if table is None:
                        row, found, whole = word_features(*part)
                        order = np.lexsort((found, row))
                        row, found, whole = row[order], found[order], whole[order]
                        new = np.ones(len(row), bool)
                        new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
                        found, whole = found[new], whole[new]
                    else:
                        found = table.hashes[table.present(*part)[1]]
                        whole = np.zeros(len(found), bool)
                    kinds, at, counts = np.unique(found, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kinds.view(np.int64)), pa.array(whole[at]), pa.array(counts.astype(np.int64))],
                        ["hash", "whole", "n"])
        return emit

    schema = "hash long, whole boolean, n long"
    toxic = (train.filter("label = 1").select("text").mapInArrow(hashes(None), schema)
             .groupBy("hash").agg(F.max("whole").alias("whole"), F.sum("n").alias("n_toxic"))
             .filter(F.col("n_toxic") >= least_texts).toPandas())
    counts = (train.select("text").mapInArrow(hashes(toxic["hash"].to_numpy(np.int64).view(np.uint64)), schema)
              .groupBy("hash").agg(F.sum("n").alias("n")).toPandas())
    n, n_toxic = train.count(), train.filter("label = 1").count()
    both = toxic.merge(counts, on="hash")
    expected = both["n"] * (n_toxic / max(n, 1))
    both["gain"] = both["n_toxic"] * np.log(both["n_toxic"] / expected)
    both = both[both["n_toxic"] >= least_lift * expected]
    return both.sort_values(["gain", "hash"], ascending=[False, True]).head(most_features).sort_values("hash")


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, fold: int = 0,
                 train_rows: int = 20_000, least_texts: int = 5, least_lift: float = 3.0,
                 most_features: int = 4096) -> Chain | float:
    """The chain, or the share of label 1 where labels of one kind are missing."""
    digest = F.crc32(F.col("doc_id").cast("string"))
    known = labels.filter(F.col(label_col).isNotNull() & (F.pmod(digest, F.lit(folds)) != fold)).groupBy(
        "doc_id").agg(F.least(F.max(label_col), F.lit(1)).alias("label"))
    rows = known.count()
    if rows > train_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * train_rows / rows))
    # at most about train_rows ids: bounded, so broadcast rather than shuffle the texts
    train = stage(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                  .join(F.broadcast(stage(known, "toxicity-labels")), "doc_id"), "toxicity-train")
    kinds = {r.label: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(kinds) != {0, 1}:
        return float(1 in kinds)
    chosen = select_features(train, least_texts, least_lift, most_features)
    hashes = chosen["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)  # sorted as unsigned
    hashes, whole = hashes[order], chosen["whole"].to_numpy(bool)[order]

    def held(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = FeatureTable(hashes)
        for batch in batches:
            raw, starts = text_bytes(batch.column("text"))
            for lo, hi in batch_slices(starts, SLICE_BYTES):
                row, feature = table.present(raw[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                at = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(feature.astype(np.int32)))],
                    ["doc_id", "label", "features"])

    sample = train.mapInArrow(held, "doc_id long, label int, features array<int>")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        row = np.repeat(np.arange(len(pdf)), pdf["features"].map(len))
        feature = np.concatenate(pdf["features"].tolist()).astype(np.int64)
        found = weak_categories(row, feature, pdf["label"].to_numpy(float), whole)
        chain = fit_chain(["insult", "severe", "toxic"], hashes, row, feature, found)
        return pd.DataFrame({"category": range(3), "weights": list(chain.weights), "earlier": list(chain.earlier),
                             "intercept": chain.intercepts})

    fitted = sample.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(
        fit, "category int, weights array<double>, earlier array<double>, intercept double").collect()
    fitted.sort(key=lambda r: r.category)
    return Chain(["insult", "severe", "toxic"], FeatureTable(hashes), np.array([r.weights for r in fitted]).reshape(3, -1),
                 np.array([r.earlier for r in fitted]), np.array([r.intercept for r in fitted]))


def score_toxicity(docs: DataFrame, chain: Chain | float, categories: tuple[str, ...] = ("insult", "severe", "toxic"),
                   keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and a probability for each category."""
    keep = ["doc_id"] if keep is None else keep
    if not isinstance(chain, Chain):
        return docs.select(*keep, *[F.lit(chain).alias(c) for c in categories])
    wire = docs.sparkSession.sparkContext.broadcast(chain)  # at most most_features weights a category

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            raw, starts = text_bytes(batch.column("__text"))
            parts = []
            for lo, hi in batch_slices(starts, SLICE_BYTES):
                hits = wire.value.features.present(raw[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                parts.append(wire.value.predict(hi - lo, *hits))
            found = np.concatenate(parts) if parts else np.zeros((0, len(categories)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(x) for x in found.T]],
                                             [*keep, *categories])

    chosen = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return chosen.mapInArrow(score, ", ".join([*kinds, *[f"{c} double" for c in categories]]))


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``doc_id, held_out, p_insult, p_severe, score, predicted``."""
    chain = fit_toxicity(docs, labels, **options)
    digest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(options.get("folds", 5)))
    scored = score_toxicity(docs.select("doc_id", "text"), chain)
    return scored.select(
        "doc_id", F.coalesce(digest == options.get("fold", 0), F.lit(False)).alias("held_out"),
        F.col("insult").alias("p_insult"), F.col("severe").alias("p_severe"), F.col("toxic").alias("score"),
        F.when(F.col("toxic") >= threshold, 1).otherwise(0).alias("predicted"))
