"""Exact top-k search by term-at-a-time accumulation.

A vector is a sparse row of integer weights, one for each component (term).
The work is a grid of blocks: a block of queries meets a block of candidates
in one task.  There, each term's postings (candidates with a weight for it)
are scattered, times each query's weight, into a dense score array (queries x
candidates); partition selection keeps the k best of each query, and the
blocks' lists are merged.  Block sizes are fixed, so a task's memory does not
grow with the table, and a merge sees k rows of each candidate block.

Defined results: vectors that are null, hold a null or non-finite component,
or have no id take no part; an empty vector scores 0 with every other; of
vectors of different lengths the missing terms weigh 0; a query's own row is
no candidate, but another row with the same id is one; ties go to the smaller
id; scores beyond 64 bits are cut at the bounds of a long; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.shared import stage

QUERIES_AT_ONCE = 128
_LONG = np.iinfo(np.int64)


def accumulate(queries: list[np.ndarray], candidates: list[np.ndarray]) -> np.ndarray:
    """Scores, queries x candidates: for each term, each query that has it
    adds its weight times the term's postings to its dense score row."""
    terms = max([len(v) for v in (*queries, *candidates)], default=0)
    most = [max((int(abs(v.astype(object)).max()) if len(v) else 0 for v in side), default=0)
            for side in (queries, candidates)]
    bound = most[0] * most[1] * max(terms, 1)
    kind = np.int32 if bound < 2 ** 31 else np.int64 if bound < 2 ** 63 else object

    def by_term(rows: list[np.ndarray]) -> np.ndarray:
        dense = np.zeros((terms, len(rows)), kind)
        for i, v in enumerate(rows):
            dense[:len(v), i] = v
        return dense

    q, c = by_term(queries), by_term(candidates)
    scores = np.zeros((len(queries), len(candidates)), kind)
    for t in range(terms):
        holders, postings = np.flatnonzero(q[t]), np.flatnonzero(c[t])
        if 2 * len(postings) >= len(candidates):  # most candidates have the term: add whole rows
            weights = c[t]
            for i in holders:
                scores[i] += q[t, i] * weights
        else:
            weights = c[t, postings]
            for i in holders:
                scores[i, postings] += q[t, i] * weights
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of one score row, best first; ``ids`` ascend."""
    if len(scores) > k:
        if scores.dtype == object:
            chosen = np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k])
        else:
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            above = np.flatnonzero(scores > cut)
            chosen = np.concatenate([above, np.flatnonzero(scores == cut)[:k - len(above)]])
    else:
        chosen = np.arange(len(scores))
    return np.array(sorted(chosen, key=lambda i: (-int(scores[i]), i)), int)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding", query_block: int = 2048, candidate_block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every row
    for which ``is_query`` holds."""
    v = F.col(vector_col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & ~odd).select(
        F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("weights"),
        F.monotonically_increasing_id().alias("row"))
    rows = stage(rows, "topk-rows")
    n, n_queries = rows.count(), rows.filter("is_query").count()
    c_blocks, q_blocks = max(1, math.ceil(n / candidate_block)), max(1, math.ceil(n_queries / query_block))
    block = lambda count, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    grid = rows.filter("is_query").select(
        "vec_id", "row", "weights", F.lit(True).alias("asks"), block(q_blocks, "q").alias("qb"), every(c_blocks).alias("cb"))
    grid = grid.unionByName(rows.select(
        "vec_id", "row", "weights", F.lit(False).alias("asks"), every(q_blocks).alias("qb"), block(c_blocks, "c").alias("cb")))

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        q = pdf[asks]
        c = pdf[~asks].sort_values(["vec_id", "row"])
        ids, own = c["vec_id"].to_numpy(), c["row"].to_numpy()
        weights, out = c["weights"].tolist(), []
        for at in range(0, len(q), QUERIES_AT_ONCE):
            some = q.iloc[at:at + QUERIES_AT_ONCE]
            scores = accumulate(some["weights"].tolist(), weights)
            for i, (row, vec_id) in enumerate(zip(some["row"], some["vec_id"], strict=True)):
                other = np.flatnonzero(own != row) if row in own else np.arange(len(own))
                top = other[best(scores[i, other], ids[other], k)]
                out.append(pd.DataFrame({
                    "query_row": row, "query_id": vec_id, "row": own[top], "vec_id": ids[top],
                    "score": [min(max(int(s), _LONG.min), _LONG.max) for s in scores[i, top]]}))
        kinds = ["query_row", "query_id", "row", "vec_id", "score"]
        return pd.concat(out) if out else pd.DataFrame({x: np.zeros(0, np.int64) for x in kinds})

    found = grid.groupBy("qb", "cb").applyInPandas(
        cell, "query_row long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
