"""Near-duplicate vectors by iterative quantisation and multi-index Hamming
tables.

Equal vectors are one class; from here on only classes count, so copies cost
one row a batch.  On a bounded sample of classes rotations are learned: the
centred vectors, projected on their principal axes, are rotated so that their
signs lose as little as possible, by turns taking the signs and solving for
the rotation that brings the vectors nearest to them.  The signs are a class's
code, balanced bits; each further rotation, learned from another start (and,
for vectors longer than a code, another projection), adds a code.

Each code is cut into substrings, and each substring is the key of one table.
Codes that differ in fewer bits than there are tables agree in some table
whole; for the pairs beyond that, as many tables are made as pairs placed at
the threshold itself need to meet with probability ``recall`` (measured on the
sample).  Substrings grow with the logarithm of the number of classes, so that
a table's bucket stays small.

Classes that meet in a bucket are compared by their whole codes.  Only those
with a partner within the Hamming radius go on, with their original vectors,
and are compared by cosine.  A pair is looked at in the first table in which
it meets and nowhere else, so links are counted in place: a bucket tells each
member's number of links and a spanning forest, never the pairs.  A bucket of
more than ``BLOCK`` classes is cut into blocks, and each two blocks meet in a
cell of their own.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing; a shorter vector is as if filled up
with zeros; rows with equal vectors are linked; repeated ids are rows of their
own; a null id names a component only if all its ids are null; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.components import connected_components
from riskspark.llm.shared import stage

FIT_ROWS = 10_000  # classes that the rotations are learned from
CODE_BITS = 64  # of one rotation
BUCKET = 64  # classes that a bucket is expected to hold
RECALL = 0.98  # of pairs at the threshold itself; pairs above it meet more often
ROUNDS = 20  # of taking signs and solving for the rotation
MOST_ROTATIONS = 64
BLOCK = 4096  # classes of a bucket compared in one cell
ENTRIES = 100_000  # codes dealt to one group
VECTORS = 25_000  # vectors dealt to one group
PAIRS = 200_000  # compared at once


@dataclass(frozen=True)
class Index:
    """Projections (one for each rotation), and of each table the code's
    number, the place of its substring and its bits."""
    mean: np.ndarray
    projections: tuple[np.ndarray, ...]
    tables: tuple[tuple[int, int, int], ...]
    radius: int

    def codes(self, units: np.ndarray) -> np.ndarray:
        """rows x rotations, a 64-bit word each."""
        out = np.zeros((len(units), len(self.projections)), np.uint64)
        for r, p in enumerate(self.projections):
            bits = (units - self.mean) @ p > 0
            for b in range(bits.shape[1]):
                out[:, r] |= bits[:, b].astype(np.uint64) << np.uint64(b)
        return out

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """rows x tables: the substrings."""
        return np.stack([(codes[:, r] >> np.uint64(at)) & np.uint64((1 << width) - 1)
                         for r, at, width in self.tables], axis=1).astype(np.int64)

    def first_meeting(self, a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Whether two codes agree in no table before the given one."""
        differ, first = a ^ b, np.ones(len(a), bool)
        for t, (r, at, width) in enumerate(self.tables):
            first &= (t >= table) | ((differ[:, r] >> np.uint64(at)) & np.uint64((1 << width) - 1) != 0)
        return first


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def learn_rotation(centred: np.ndarray, axes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Iterative quantisation on the projection to ``axes``."""
    v = centred @ axes
    rotation = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
    for _ in range(ROUNDS):
        signs = np.where(v @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ v)
        rotation = (left @ right).T
    return axes @ rotation


def fit(sample: np.ndarray, classes: int, threshold: float, recall: float = RECALL, seed: int = 11) -> Index:
    """Rotations are added until pairs placed at the threshold meet often enough."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    bits = min(CODE_BITS, dim)
    width = min(bits, max(4, math.ceil(math.log2(max(classes, 2) / BUCKET))))
    mean = sample.mean(0)
    centred = sample - mean
    principal = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
    some = sample[rng.integers(0, len(sample), 2000)]
    aside = rng.standard_normal(some.shape)
    aside -= (aside * some).sum(1, keepdims=True) * some
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    partner = threshold * some + math.sqrt(1 - threshold ** 2) * aside
    projections, tables = [], []
    while True:
        axes = principal if not projections or dim <= CODE_BITS else np.linalg.qr(rng.standard_normal((dim, bits)))[0]
        projections.append(learn_rotation(centred, axes, rng))
        tables += [(len(projections) - 1, width * k, width) for k in range(bits // width)]
        index = Index(mean, tuple(projections), tuple(tables), 0)
        a, b = index.codes(some), index.codes(partner)
        meets = (index.keys(a) == index.keys(b)).any(1).mean()
        if meets >= recall or len(projections) >= MOST_ROTATIONS:
            radius = int(np.quantile(distances(a, b), 0.9999)) + 1
            return Index(mean, tuple(projections), tuple(tables), radius)


def unit_vectors(column) -> np.ndarray:
    """Arrow lists of doubles (all of one length) as rows of length 1."""
    n = len(column)
    v = column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _runs(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of equal keys."""
    n = len(keys[0])
    new = np.ones(n + 1, bool)
    if n:
        new[1:n] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return at[:-1], at[1:]


def meetings(begin: np.ndarray, end: np.ndarray, across: np.ndarray, second: np.ndarray) -> Iterator[tuple]:
    """Pairs (i, j) of members of a run, a bounded number at a time; of a run
    across two blocks, those with one member in each (``second`` is sorted
    within a run)."""
    size = end - begin
    small = (size <= 256) & ~across & (size > 1)
    begins, sizes = begin[small], size[small]
    made = np.cumsum(sizes * (sizes - 1) // 2)
    at = 0
    while at < len(begins):  # many small runs at once
        done = int(np.searchsorted(made, (made[at - 1] if at else 0) + PAIRS, "left")) + 1
        b, s = begins[at:done], sizes[at:done]
        place = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        later = np.repeat(s, s) - 1 - place
        i = np.repeat(np.repeat(b, s) + place, later)
        j = i + 1 + np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later)
        yield i, j
        at = done
    for b, e, two in zip(begin[~small], end[~small], across[~small], strict=True):
        split = int(np.searchsorted(second[b:e], True)) + b if two else e
        step = 256
        for x in range(b, split, step):
            i = np.arange(x, min(x + step, split))
            for y in range(split if two else x, e, step):
                j = np.arange(y, min(y + step, e))
                i2, j2 = np.repeat(i, len(j)), np.tile(j, len(i))
                if not two and x == y:
                    i2, j2 = i2[i2 < j2], j2[i2 < j2]
                if len(i2):
                    yield i2, j2


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of linked members; labels are the smallest member's."""
    while True:
        a, b = label[i], label[j]
        if np.array_equal(a, b):
            return
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


def _sorted_cells(pdf: pd.DataFrame) -> tuple[pd.DataFrame, tuple]:
    pdf = pdf.assign(second=(pdf["own"] == pdf["high"]) & (pdf["low"] != pdf["high"])).sort_values(
        ["slot", "key", "low", "high", "second", "cid"])
    cell = [pdf[x].to_numpy() for x in ("slot", "key", "low", "high")]
    begin, end = _runs(cell)
    across = cell[2][begin] != cell[3][begin] if len(begin) else np.zeros(0, bool)
    return pdf, (begin, end, across, pdf["second"].to_numpy(bool))


def _words(codes: pd.Series, rotations: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.uint64).reshape(-1, rotations)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                    fit_rows: int = FIT_ROWS, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row for each of ``vectors``."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable, v.cast("array<double>")).alias("v"))
    rows = rows.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64("v", F.lit("v")))
    length = rows.agg(F.max(F.size("v"))).first()[0] or 0
    classes = rows.filter("v is not null").groupBy("v", "h1", "h2").agg(
        F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("least"))
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(length) - F.size("v")))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("cid"), filled.alias("v"), "h1", "h2", "times", "least"),
                    "itq-classes")
    n = classes.count()
    if n:
        sample = classes.orderBy("h1", "h2").limit(fit_rows).select("v").toArrow().column(0).combine_chunks()
        found = _links(classes, n, spark.sparkContext.broadcast(fit(unit_vectors(sample), n, threshold, recall)), threshold, block)
        edges = found.filter("cid <> label").select(F.col("cid").alias("a"), F.col("label").alias("b"))
        parts = connected_components(edges).withColumnRenamed("node", "cid")
        classes = classes.drop("v").join(found.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(
            parts, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    else:
        classes = classes.drop("v").select("*", F.lit(0).cast("long").alias("links"), F.col("cid").alias("component"))
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = classes.join(smallest, "component").select(
        "h1", "h2", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id", F.lit(True).alias("linked"))
    plain = rows.select("vec_id", "h1", "h2", F.col("v").isNotNull().alias("linked"))
    out = plain.join(known, ["h1", "h2", "linked"], "left")
    out = out.withColumn("component_id", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _links(classes: DataFrame, n: int, index, threshold: float, block: int) -> DataFrame:
    """``cid, label, links``: rows of each cell in which a class has links:
    how many, and the smallest class of its tree there."""
    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            codes = index.value.codes(unit_vectors(batch.column("v")))
            keys = index.value.keys(codes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(list(keys), pa.list_(pa.int64()))], ["cid", "code", "keys"])

    tables, rotations, radius = len(index.value.tables), len(index.value.projections), index.value.radius
    codes = stage(classes.select("cid", "v").mapInArrow(encode, "cid long, code binary, keys array<long>"), "itq-codes")
    entries = codes.select("cid", "code", F.posexplode("keys").alias("slot", "key"))
    crowded = stage(entries.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > block).select(
        "slot", "key", F.ceil(F.col("held") / block).alias("blocks")), "itq-crowded")
    few = crowded.count() <= 100_000  # of two numbers and a table's number
    entries = entries.join(F.broadcast(crowded) if few else crowded, ["slot", "key"], "left").fillna(1, ["blocks"])
    cells = entries.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "cid", "code", "slot", "key", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def dealt(rows: DataFrame, groups: int):
        return rows.withColumn("deal", F.pmod(F.xxhash64("slot", "key", "low", "high"), F.lit(max(1, groups)))).groupBy("deal")

    def near(pdf: pd.DataFrame, cell: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        words, slot = _words(pdf["code"], rotations), pdf["slot"].to_numpy()
        for i, j in meetings(*cell):
            close = distances(words[i], words[j]) <= radius
            i, j = i[close], j[close]
            first = index.value.first_meeting(words[i], words[j], slot[i])
            if first.any():
                yield i[first], j[first]

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, cell = _sorted_cells(pdf)
        asks = np.zeros(len(pdf), bool)
        for i, j in near(pdf, cell):
            asks[i] = asks[j] = True
        return pdf.loc[asks, ["cid", "slot", "key", "own", "low", "high"]]

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, cell = _sorted_cells(pdf)
        units = np.stack(pdf["v"].to_list()).astype(np.float64)
        units /= np.abs(units).max(1, keepdims=True)
        units /= np.sqrt((units * units).sum(1, keepdims=True))
        times, links, label = pdf["times"].to_numpy(), np.zeros(len(pdf), np.int64), np.arange(len(pdf))
        for i, j in near(pdf, cell):
            linked = np.einsum("ij,ij->i", units[i], units[j]) >= threshold
            i, j = i[linked], j[linked]
            np.add.at(links, i, times[j])
            np.add.at(links, j, times[i])
            _merge(label, i, j)
        cid, has = pdf["cid"].to_numpy(), links > 0
        return pd.DataFrame({"cid": cid[has], "label": cid[label[has]], "links": links[has]})

    asked = stage(dealt(cells, math.ceil(n * tables / ENTRIES)).applyInPandas(ask, "cid long, slot int, key long, own long, low long, high long"),
                  "itq-asked")
    whole = asked.join(codes.select("cid", "code"), "cid").join(classes.select("cid", "v", "times"), "cid")
    return stage(dealt(whole, math.ceil(asked.count() / VECTORS)).applyInPandas(verify, "cid long, label long, links long"), "itq-links")
