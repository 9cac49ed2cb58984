"""Packing documents into sequences by hierarchical residual best fit.

Each document is encoded once, where it lies, to pieces of at most
``capacity`` tokens (only longer documents are cut; their first piece takes
the remainder).  Full pieces are sequences.  The others are dealt to groups;
each group packs its items best-fit, longest first, into bins.  Bins that are
full but for ``slack`` tokens are final; underfull bins become items of the
next round, with fewer groups, and so up the tree until one group is left or
no item of at most half the capacity is (then no two fit together).  A group
leaves at most one such item, and a pair that fits has one; so of each length
a round takes no more items than there are of these, and none that is too
long for the shortest.  Only (item, length) pairs move; texts and ids stay.

Defined results: a null text is an empty text, whose only token is the
separator; repeated rows and repeated or null ids are packed each on its own;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.shared import stage, tidy
from riskspark.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 0,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with a number of its own (``item``); a stage."""
    def pieces(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc, end = encoder(tokenizer_path), np.array([separator], "<u4")
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.concatenate([enc.encode(text.as_py() or "").astype("<u4"), end])
                start, piece = 0, 0
                while start < len(ids):
                    length = (len(ids) - start) % capacity or capacity
                    out.append((doc_id.as_py(), piece, start, length,
                                zlib.crc32(ids[start:start + length].tobytes())))
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in
                 enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(pieces), PIECES)
    return stage(cut.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")


def best_fit(items: list[int], lengths: list[int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Best fit, longest first: (item, bin, offset, fill of the bin at the
    end).  A bin is named by its first item.  Bins wait in one list for each
    free length; a bit set of the free lengths in use finds the smallest that
    is enough."""
    order = sorted(range(len(items)), key=lambda i: (-lengths[i], items[i]))
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use, placed, fill, name = 0, [], [], []
    for i in order:
        length = lengths[i]
        usable = in_use >> length
        if usable:
            free = length + (usable & -usable).bit_length() - 1
            b = waiting[free].pop()
            if not waiting[free]:
                in_use &= ~(1 << free)
        else:
            b, free = len(fill), capacity
            fill.append(0)
            name.append(items[i])
        placed.append((items[i], b, fill[b]))
        fill[b] += length
        free -= length
        if free:
            waiting[free].append(b)
            in_use |= 1 << free
    return [(item, name[b], offset, fill[b]) for item, b, offset in placed]


def pack(pieces: DataFrame, capacity: int = 2048, slack: int = 8, group_items: int = 16384) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(best_fit(pdf["item"].tolist(), pdf["length"].tolist(), capacity),
                            columns=["item", "bin", "offset", "fill"])

    items = pieces.filter(F.col("length") < capacity).select("item", "length")
    count, rounds = items.count(), []
    groups = math.ceil(count / group_items)
    while count:
        dealt = items.withColumn("g", F.pmod(F.xxhash64("item", F.lit(len(rounds))), F.lit(groups)))
        packed = stage(dealt.groupBy("g").applyInPandas(
            pack_group, "item long, bin long, offset long, fill long"), "pack-round")
        rounds.append(packed)
        items = packed.filter((F.col("offset") == 0) & (F.col("fill") < capacity - slack)).select(
            F.col("bin").alias("item"), F.col("fill").alias("length"))
        if groups == 1:
            break
        small = items.filter(F.col("length") * 2 <= capacity).agg(
            F.count(F.lit(1)).alias("items"), F.min("length").alias("shortest")).first()
        if not small["items"]:
            break
        # exact: an item that is set aside here has no partner, or others of its length are enough
        one_length = Window.partitionBy("length").orderBy("item")
        items = items.filter(F.col("length") + small["shortest"] <= capacity).withColumn(
            "nth", F.row_number().over(one_length)).filter(F.col("nth") <= small["items"]).drop("nth")
        items = stage(items, "pack-items")
        count = items.count()
        groups = min(math.ceil(count / group_items), max(1, groups // 8))  # up the tree, fewer items meet in fewer groups
    out = pieces.select("*", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for packed in rounds:
        up = packed.select(F.col("item").alias("sequence_id"), "bin", F.col("offset").alias("more"))
        out = out.join(up, "sequence_id", "left").withColumn(
            "sequence_id", F.coalesce("bin", "sequence_id")).withColumn(
            "offset", F.col("offset") + F.coalesce("more", F.lit(0))).drop("bin", "more")
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, **options) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(cut_pieces(docs, tokenizer_path, capacity), capacity, **options).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
