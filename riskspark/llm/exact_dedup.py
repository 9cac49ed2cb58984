"""Exact deduplication on an extendible-hash index.

Native: DataFrame functions only.

1. Index pass: every text is normalised and hashed; the index rows (id, key,
   length, SHA-256; no text) are written to the shared folder.
2. Directory: the key's leading bits address it.  It doubles until no bucket
   holds more distinct keys than its capacity; a bucket's local depth is the
   shortest prefix that is not overfull.  Rows of one key are never split by
   doubling, so they count once and are chained instead.  The directory is a
   table in the shared folder; the driver sees one number per doubling.
3. Owner tasks: keys that more than one row holds are fetched with their
   texts, dealt by bucket (a key range), and texts of one key are compared
   byte by byte: grouping on (bucket, key, text) makes one chain entry for
   each different text.  Copies are combined before the shuffle, so a group
   of copies costs one row for each map task.

Defined results: a null text is an empty text, and all empty texts are equal;
of rows with equal text and equal id exactly one stays; a null id is smaller
than any other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.shared import ascii_lower, least_row, stage

DEFAULT_CAPACITY = 8192


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def _key(norm: Column, key_bits: int) -> Column:
    """64-bit key; fewer bits (tests) keep the leading ones, so keys collide."""
    key = F.xxhash64(norm)
    drop = 64 - key_bits
    return F.shiftleft(F.shiftrightunsigned(key, drop), drop) if drop else key


def build_directory(keys: DataFrame, capacity: int, key_bits: int = 64) -> tuple[DataFrame, int]:
    """Directory of the index: (slot, depth, bucket) for every occupied slot
    at the global depth, and that depth.  ``keys`` has one row per key."""
    depth = min(key_bits, max(0, math.ceil(math.log2(max(1, keys.count()) / capacity))))
    while True:
        slots = stage(keys.groupBy(_prefix(F.col("key"), depth).alias("slot"))
                      .agg(F.count(F.lit(1)).alias("load")), "dedup-slots")
        overfull = slots.filter(F.col("load") > capacity).count()
        if not overfull or depth == key_bits:
            break
        depth += 1  # the directory doubles; only overfull buckets get new siblings
    # (slot, level) for each level; the local depth is the first level at
    # which the prefix is not overfull
    levels = slots.select("slot", "load", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    levels = levels.withColumn("bucket", F.shiftrightunsigned("slot", 0) if not depth else F.expr(
        f"shiftrightunsigned(slot, {depth} - level)"))
    fits = levels.groupBy("level", "bucket").agg(F.sum("load").alias("bucket_load")).filter(
        (F.col("bucket_load") <= capacity) | (F.col("level") == depth))
    local = (levels.join(fits, ["level", "bucket"]).groupBy("slot")
             .agg(F.min(F.struct("level", "bucket")).alias("b"))
             .select("slot", F.col("b.level").alias("depth"), F.col("b.bucket").alias("bucket")))
    return stage(local, "dedup-directory"), depth


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = DEFAULT_CAPACITY, key_bits: int = 64) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256, bucket, chain`` (bucket and chain are null for texts that
    occur once and share their key with no other)."""
    norm = F.coalesce(ascii_lower(F.col(text_col)), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
    texts = texts.withColumn("key", _key(F.col("norm"), key_bits))
    entries = stage(texts.select(
        "doc_id", "key", F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2("norm", 256)).alias("sha")), "dedup-index")

    keys = stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")), "dedup-keys")
    directory, depth = build_directory(keys, capacity, key_bits)
    shared = (keys.filter("n_rows > 1").withColumn("slot", _prefix(F.col("key"), depth))
              .join(directory, "slot").select("key", "depth", "bucket"))
    shared = stage(shared, "dedup-shared-keys")

    # texts of shared keys, dealt to the owners of their key ranges; ~key
    # hides the join's partitioning, so that the aggregate combines copies
    # before its own shuffle and a hot key stays split across tasks
    chained = (texts.join(shared, "key")
               .select("depth", "bucket", F.bitwise_not("key").alias("nkey"), "norm")
               .groupBy("depth", "bucket", "nkey", "norm").agg(F.count(F.lit(1)).alias("group_size"))
               .select("depth", "bucket", F.bitwise_not("nkey").alias("key"), "group_size",
                       F.unhex(F.sha2("norm", 256)).alias("sha")))
    at = Window.partitionBy("bucket", "depth", "key").orderBy("sha")
    chained = chained.withColumn("chain", F.row_number().over(at))
    # the row that stays, by (key, digest); a digest that stood for two
    # different texts would have two chain entries
    best = (entries.join(shared.select("key"), "key", "left_semi")
            .groupBy(F.bitwise_not("key").alias("nkey"), "sha")
            .agg(F.max(F.struct("doc_id", "row")).alias("best"))
            .select(F.bitwise_not("nkey").alias("key"), "sha", "best"))
    groups = chained.join(best, ["key", "sha"])
    groups = groups.groupBy("key", "sha").agg(
        F.first("best").alias("best"), F.first("group_size").alias("group_size"),
        F.min("bucket").alias("bucket"), F.min("chain").alias("chain"), F.count(F.lit(1)).alias("texts"))
    groups = stage(groups.withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.lit("two texts with one SHA-256 and one key")))).drop("texts"), "dedup-groups")
    out = entries.join(groups, ["key", "sha"], "left")
    alone = F.col("best").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "bucket", "chain")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The copies' ids are few beside the texts, so the texts are anti-joined
    to them rather than shuffled to their decisions.  Ids that occur more
    than once (or are null) can't name a row; those rows are decided by id
    and text."""
    result = stage(exact_dedup(docs, id_col, text_col)
                   .select("doc_id", "kept", F.unhex("text_sha256").alias("sha")), "dedup-result")
    vague = result.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(
        "n > 1 and doc_id is not null").select("doc_id")
    vague = stage(vague, "dedup-vague-ids")
    out_ids = stage(result.filter("not kept and doc_id is not null").select("doc_id")
                    .unionByName(vague), "dedup-dropped-ids")
    columns = docs.columns
    clear = docs.filter(F.col(id_col).isNotNull()).join(
        out_ids.withColumnRenamed("doc_id", id_col), id_col, "left_anti").select(columns)
    sha = F.unhex(F.sha2(F.coalesce(ascii_lower(F.col(text_col)), F.lit("")), 256))
    unclear = docs.filter(F.col(id_col).isNull()).unionByName(
        docs.join(vague.withColumnRenamed("doc_id", id_col), id_col, "left_semi").select(columns))
    # one row for each (id, text) whose decision is to stay
    one = unclear.groupBy(F.col(id_col).alias("__id"), sha.alias("__sha")).agg(
        least_row(columns).alias("__row"))
    stays = result.filter("kept").select("doc_id", "sha").distinct()
    one = one.join(stays, F.col("__id").eqNullSafe(stays.doc_id) & (F.col("__sha") == stays.sha), "left_semi")
    return clear.unionByName(one.select("__row.*"))
