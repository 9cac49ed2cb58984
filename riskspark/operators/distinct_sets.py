"""Exact distinct sets that merge: counts of distinct keys per period, kept as
bitmaps, so that longer periods are read from shorter ones.

A set is kept in pieces.  A key belongs to one of ``parts`` by its hash, and
within the part it has a number in the keys' order; a piece is the bitmap of
32,768 numbers of one part.  Numbers are dense, so a piece is as full as the
set is, and a set's pieces are spread over the cluster however large it is.
There are no collisions: two keys never share a number of one part.

The states of one call number their keys alike.  States of different calls do
not, and must not be merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fewer parts make fuller pieces, more parts smaller sorts (they may spill)
PARTS = 64
_TOTAL = "_all"


def distinct_states(df: DataFrame, by: Sequence[str], key: str, conditions: Mapping[str, Column],
                    parts: int = PARTS) -> DataFrame:
    """The distinct keys of each ``by`` group, and those with a row that
    satisfies each condition: ``by``, ``_part``, ``_piece``, a bitmap ``_all``
    and one for each condition.

    Rows are reduced to one per (group, key) before any key is numbered.  NULL
    keys are in no set, but a group that has only them has an (empty) state.
    """
    flags = [F.max(F.coalesce(cond, F.lit(False)).cast("int")).alias(name) for name, cond in conditions.items()]
    per_key = (df.groupBy(*by, key).agg(*flags) if flags else df.select(*by, key).distinct())
    k = F.col(key)
    # a part holds 1/parts of the distinct keys, so its sort stays small
    numbered = (per_key.withColumn("_part", F.pmod(F.xxhash64(k), F.lit(parts)).cast("int"))
                .withColumn("_n", F.when(k.isNotNull(), F.dense_rank().over(
                    Window.partitionBy("_part").orderBy(k.asc_nulls_last())).cast("bigint"))))
    bit = F.bitmap_bit_position("_n")  # numbers from 1: 0 and 1 would share a position
    return (numbered.groupBy(*by, "_part", F.bitmap_bucket_number("_n").alias("_piece"))
            .agg(F.bitmap_construct_agg(bit).alias(_TOTAL),
                 *(F.bitmap_construct_agg(F.when(F.col(name) == 1, bit)).alias(name) for name in conditions)))


def merge_states(states: DataFrame, by: Mapping[str, Column], conditions: Sequence[str]) -> DataFrame:
    """States of coarser groups: ``by`` gives their columns from the finer
    ones'.  A key that several finer groups hold counts once."""
    return (states.select("_part", "_piece", _TOTAL, *conditions, *(c.alias(n) for n, c in by.items()))
            .groupBy(*by, "_part", "_piece")
            .agg(*(F.bitmap_or_agg(c).alias(c) for c in (_TOTAL, *conditions))))


def count_states(states: DataFrame, by: Sequence[str], total_name: str, conditions: Sequence[str]) -> DataFrame:
    """``by``, ``total_name`` and a count for each condition: as
    ``aggs.conditional_distinct_counts`` gives them."""
    return states.groupBy(*by).agg(F.sum(F.bitmap_count(_TOTAL)).alias(total_name),
                                   *(F.sum(F.bitmap_count(c)).alias(c) for c in conditions))
