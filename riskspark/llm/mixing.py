"""Mixing sources to target weights by Pareto order sampling.

Native: DataFrame functions only.

Each source's target is a share of the mix by weight, cut at ``max_copies``
times the source's size, with the excess dealt again by weight until no
target is above.  A document's expected copies are target / size of its
source (times its own weight relative to the source's mean, if a weight
column is given).  The whole part is taken for certain; the rest is an
inclusion probability p.  Documents are ranked by random odds u/(1-u) divided
by inclusion odds p/(1-p), and the smallest ranks are taken until the words
left in the source's target are used up (the last one if it brings the sum
nearer).  u is a digest of the id, so reruns agree.

The cut in a source's ranking is found by radix selection: sums for 4096
ranges of the rank, then 4096 ranges inside the one that holds the cut, and
so on; only rows that agree with the cut in 36 bits are ordered in a window.
A source that holds a third of all rows is thus never sorted in one task.

Defined results: a null text has size 0 and takes 0; a null source is a
source of its own, last in order; equal ranks are ordered by id, then size;
of repeated rows any may be taken; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.shared import join_checked, stage, word_count

DEFAULT_WEIGHTS = (5, 2, 1)
RADIX_BITS, ROUNDS = 12, 3


def source_targets(sources: DataFrame, weights=DEFAULT_WEIGHTS, total_share: float = 1.5,
                   max_copies: int = 2) -> DataFrame:
    """``sources`` (skey, source, source_size), one row each, with ``target``.
    Both windows run over sources, not documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn(
        "bound", F.col("source_size").cast("double") * max_copies)
    # filled in order of bound / weight: a source is cut if its share of what
    # is left, among those left, passes its bound
    fill = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    size, w = F.sum(F.col("source_size").cast("double")).over(every), F.sum("weight").over(every)
    left = F.lit(float(total_share)) * size - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    left_weight = w - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("cut", left * F.col("weight") >= F.col("bound") * left_weight)
    s = s.withColumn("level", (F.lit(float(total_share)) * size
                               - F.sum(F.when(F.col("cut"), F.col("bound")).otherwise(0.0)).over(every))
                     / F.nullif(F.sum(F.when(F.col("cut"), 0.0).otherwise(F.col("weight"))).over(every), F.lit(0.0)))
    return s.select("skey", "source", "source_size",
                    F.when(F.col("cut"), F.col("bound")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) from a digest of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 48))


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights=DEFAULT_WEIGHTS, total_share: float = 1.5, max_copies: int = 2,
               weight_col: str | None = None, seed: str = "mix", row_col: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken,
    copies``, and ``row`` if ``row_col`` names a key of the rows."""
    row = ["row"] if row_col else []
    own = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    items = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.when(F.col(source_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source_col))).alias("skey"),
        word_count(F.col(text_col)).alias("size"), F.coalesce(own, F.lit(1.0)).alias("own"),
        uniform(F.col(id_col), seed).alias("u"), *[F.col(row_col).alias(x) for x in row])
    items = stage(items, "mix-items")
    sources = stage(items.groupBy("skey").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"),
        F.sum(F.col("own") * F.col("size")).alias("own_size")), "mix-sources")
    targets = source_targets(sources.drop("own_size"), weights, total_share, max_copies).join(
        sources.select("skey", "own_size"), "skey")
    targets = stage(targets, "mix-targets")

    ratio = F.coalesce(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(0.0))
    if weight_col:
        ratio = ratio * F.col("own") * F.col("source_size") / F.nullif(F.col("own_size"), F.lit(0.0))
    copies = F.least(F.coalesce(ratio, F.lit(0.0)), F.lit(float(max_copies)))
    ranked = items.join(targets.drop("source"), "skey").withColumn("expected", copies)
    ranked = ranked.withColumn("whole", F.floor("expected").cast("long"))
    p = F.col("expected") - F.col("whole")
    odds = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    # the rank, order-preserving, as a 36-bit number; null: nothing to draw
    ranked = ranked.withColumn("rank", F.when(p > 0, F.least(
        F.floor(odds / (1 + odds) * F.lit(float(2 ** (RADIX_BITS * ROUNDS)))),
        F.lit(2 ** (RADIX_BITS * ROUNDS) - 1)).cast("long")))
    ranked = stage(ranked.select("skey", "doc_id", "size", "source_size", "target", "whole", "rank", *row), "mix-ranked")

    state = ranked.groupBy("skey").agg(
        (F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("budget"))
    # cut: the rank's leading bits at the cut; -1: all are taken
    state = stage(state.withColumn("cut", F.lit(0).cast("long")), "mix-cut")
    for r in range(1, ROUNDS + 1):
        shift = RADIX_BITS * (ROUNDS - r)
        prefix = F.shiftright("rank", shift)
        inside = ranked.filter("rank is not null").join(state, "skey").filter(
            F.shiftright("rank", shift + RADIX_BITS) == F.col("cut"))
        cells = inside.groupBy(F.struct("skey", prefix.alias("prefix")).alias("cell")).agg(
            F.sum("size").alias("cell_size"))
        cells = cells.select("cell.skey", "cell.prefix", "cell_size")
        upto = Window.partitionBy("skey").orderBy("prefix")  # at most 4096 rows a source
        cells = cells.withColumn("upto", F.sum("cell_size").over(upto))
        cross = cells.join(state, "skey").filter(F.col("upto") > F.col("budget")).groupBy("skey").agg(
            F.min(F.struct("prefix", (F.col("upto") - F.col("cell_size")).alias("passed"))).alias("c"))
        state = stage(state.join(cross, "skey", "left").select(
            "skey", (F.col("budget") - F.coalesce("c.passed", F.lit(0))).alias("budget"),
            F.coalesce("c.prefix", F.lit(-1)).cast("long").alias("cut")), "mix-cut")

    at = ranked.join(state, "skey")
    edge = at.filter("rank = cut and cut >= 0")
    run = Window.partitionBy("skey").orderBy("rank", "doc_id", "size")
    edge = edge.withColumn("passed", F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0))
                           - F.col("size"))
    edge = edge.withColumn("extra", F.col("passed") + F.col("size") / 2.0 <= F.col("budget"))
    rest = at.filter("rank is null or cut < 0 or rank <> cut").withColumn(
        "extra", F.col("rank").isNotNull() & ((F.col("cut") < 0) | (F.col("rank") < F.col("cut"))))
    columns = ["doc_id", "size", "source_size", "target", "whole", "extra", *row]
    out = rest.select(columns).unionByName(edge.select(columns))
    times = F.col("whole") + F.coalesce(F.col("extra"), F.lit(False)).cast("long")
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * times).alias("taken"), times.alias("copies"), *row)


def repeat_mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: each taken copy of a document as a row of
    ``docs``.  Ids name the rows; rows whose id is null or repeated get a key
    of their own, written with them, so that each takes its own copies."""
    id_col = options.get("id_col", "doc_id")
    vague = docs.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("__n")).filter(
        "__n > 1").select(id_col)
    vague = stage(vague, "mix-vague-ids")
    clear = join_checked(docs.filter(F.col(id_col).isNotNull()), vague, id_col, "left_anti").select(docs.columns)
    unclear = docs.filter(F.col(id_col).isNull()).unionByName(
        join_checked(docs, vague, id_col, "left_semi").select(docs.columns))
    unclear = stage(unclear.withColumn("__row", F.monotonically_increasing_id()), "mix-unclear")
    mix = pareto_mix(clear.withColumn("__row", F.lit(None).cast("long")).unionByName(unclear), row_col="__row", **options)
    mix = stage(mix.filter("copies > 0").select("doc_id", F.col("row").alias("__row"), F.col("copies").alias("__copies")),
                "mix-copies")
    by_id = mix.filter("__row is null").select(F.col("doc_id").alias(id_col), "__copies")
    by_row = mix.filter("__row is not null").select("__row", "__copies")
    out = join_checked(clear, by_id, id_col).select(*docs.columns, "__copies").unionByName(
        join_checked(unclear, by_row, "__row").select(*docs.columns, "__copies"))
    return out.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(docs.columns)
