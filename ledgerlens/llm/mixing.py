"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in
DataFrame operations only.

A source whose target is ``e`` whole passes over it and a rest takes every
document ``e`` times (complete epochs come first) and fills the rest by
weighted sampling without replacement: each document draws the exponential
key ``-ln(u) / w`` (``u`` from a hash of its id, ``w`` its quality weight),
documents are sorted by key within the source and taken while their running
size stays within the rest.

The running sums have two levels: keys fall into ``BINS`` ordered bins, bins
are summed per source with map-side partial sums, and only the one bin of a
source in which the budget ends is sorted, so a source with a third of all
rows is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, Stages

#: ordered key bins per source
BINS = 1 << 14


def source_targets(sized: DataFrame, weights: list[int], total_share: float, max_epochs: float) -> DataFrame:
    """``source, source_size, target``. Sources in code-point order, null
    last, have the ``weights`` in turn and share ``total_share`` of all sizes
    by weight; a target stops at ``max_epochs`` times its source's size, and
    the excess is shared again by weight until none is above.

    That end is found directly: with sources ordered by cap per weight, the
    capped ones are a prefix, and the others get ``level * weight``.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    caps = (sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
            .withColumn("ratio", F.col("cap") / F.col("weight")))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    caps = (caps.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(total_share)))
            .withColumn("all_weight", F.sum("weight").over(everything))
            .withColumn("level", level))
    # the first source, in this order, that its share does not fill sets the level of all that follow
    open_level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)
    return caps.withColumn("open", open_level).select(
        "source", "source_size",
        F.when(F.col("open").isNull() | (F.col("ratio") < F.col("open.ratio")), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("open.level"))).alias("target"))


def uniform(id_col: str, salt: str) -> Column:
    """A number in (0, 1) from the first 52 bits of the MD5 of id and salt."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"/{salt}"))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text_col: str, size: Column) -> Column:
    """1 for a text without symbol characters, less the more it has per word."""
    symbols = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[#*$%&|<>{}]")), F.lit(0))
    return size / (size + 4.0 * symbols + (size == 0).cast("double"))


def mix(docs: DataFrame, stages: Stages, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: list[int] | None = None, total_share: float = 1.5, max_epochs: float = 2.0,
        cut_last: bool = True, salt: str = "mix") -> DataFrame:
    """One row per input row: ``doc_id, th, size, source, source_size, target,
    taken``. ``size`` is the number of words (null text: 0), ``taken`` the
    words the mix takes, repeats counted; ``th`` (hash of the text) tells
    repeated ids apart.

    With ``cut_last`` the document at which the budget ends is taken up to the
    budget, so a source's ``taken`` is its target rounded; without it, it is
    taken whole when that ends nearer to the target. Null ids draw like the
    empty id, ties of keys go by id and text, rows equal in both share a tie
    in any order. Documents without words take nothing. An empty table gives
    an empty result.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        F.xxhash64(text_col).alias("th"), word_count(text_col).alias("size"),
                        F.col(text_col).alias("text"))
    u = uniform("doc_id", salt)
    sized = stages.write(
        sized.withColumn("w", F.greatest(quality_weight("text", F.col("size")), F.lit(0.05)))
        .select("doc_id", "source", "th", "size", (-F.log(u) / F.col("w")).alias("key")), "sized")
    plan = (source_targets(sized, weights or [3, 1, 2], total_share, max_epochs)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
            .withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")))
    plan = stages.write(plan, "plan")
    # 1 - exp(-key) spreads keys of weight 1 evenly over the bins
    bin_of = F.floor((1.0 - F.exp(-F.col("key"))) * F.lit(BINS)).cast("int")
    keyed = sized.withColumn("bin", bin_of)
    bins = keyed.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("ahead", F.coalesce(F.sum("bin_size").over(running), F.lit(0)))
    same_source = F.col("p.source").eqNullSafe(F.col("b.source"))
    # of each source: the bin in which its rest ends
    edge = (bins.alias("b").join(plan.alias("p"), same_source)
            .where("b.ahead <= p.rest and b.ahead + b.bin_size > p.rest")
            .select(F.col("p.source").alias("e_source"), F.col("b.bin").alias("e_bin"), F.col("b.ahead").alias("e_ahead")))
    planned = (keyed.alias("k").join(plan.alias("p"), F.col("k.source").eqNullSafe(F.col("p.source")))
               .select("k.*", "p.source_size", "p.target", "p.epochs", "p.rest")
               .join(edge, F.col("source").eqNullSafe(F.col("e_source")), "left").drop("e_source"))
    inside = planned.where(F.col("bin") == F.col("e_bin"))
    outside = planned.where(F.col("e_bin").isNull() | (F.col("bin") != F.col("e_bin")))
    by_key = (Window.partitionBy("source").orderBy("key", "doc_id", "th")
              .rowsBetween(Window.unboundedPreceding, -1))
    room = F.col("rest") - F.col("e_ahead") - F.coalesce(F.sum("size").over(by_key), F.lit(0))
    part = (F.least(F.col("size"), F.greatest(F.lit(0), room)) if cut_last
            else F.when(room * 2 >= F.col("size"), F.col("size")).otherwise(0))
    inside = inside.withColumn("part", part)
    outside = outside.withColumn("part", F.when(F.col("e_bin").isNull() & (F.col("rest") == 0), 0)
                                 .when(F.col("e_bin").isNull() | (F.col("bin") < F.col("e_bin")), F.col("size")).otherwise(0))
    return inside.unionByName(outside).select(
        "doc_id", "th", "size", "source", F.col("source_size").cast("long"), F.col("target").cast("double"),
        (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))
