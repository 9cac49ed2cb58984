"""Aggregation operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_distinct_counts(df: DataFrame, by: Sequence[str], key: str,
                                total_name: str | None,
                                conditions: Mapping[str, Column]) -> DataFrame:
    """``count(distinct key)`` and ``count(distinct case when cond then key end)``
    for several conditions, per ``by`` group, without ``Expand``.

    A key counts for a condition when any of its rows satisfies it, so the
    rows are first reduced to one per (group, key) with ``max`` of 0/1 flags,
    then counted and summed per group.  Both steps aggregate partially before
    their shuffle; a group holding most of the rows is spread over the
    (group, key) partitions in the first step and only partial counts reach
    the second.  NULL keys are not counted, and a group with only NULL keys
    still appears, with zero counts.
    """
    flags = [F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0))).alias(f"_f{i}")
             for i, cond in enumerate(conditions.values())]
    if flags:
        per_key = df.groupBy(*by, key).agg(*flags)
    else:
        per_key = df.select(*by, key).distinct()
    k = F.col(key)
    outs = []
    if total_name:
        outs.append(F.count(k).alias(total_name))
    for i, name in enumerate(conditions):
        outs.append(F.sum(F.when(k.isNotNull(), F.col(f"_f{i}")).otherwise(F.lit(0)))
                    .cast("bigint").alias(name))
    return per_key.groupBy(*by).agg(*outs)
