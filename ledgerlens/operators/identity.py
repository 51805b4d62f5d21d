"""Identity by several keys: rows that share any of them are one thing.

A primary key and its alternatives link transitively: a row that carries
both joins the rows of the one with the rows of the other. Groups are the
connected components of the keys, not of the rows, so copies of a key add
nothing and a hot key is one node.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.dedup import flag_duplicates
from ledgerlens.operators.joins import as_list, join_per_key
from ledgerlens.session import remove_path, scratch_path


def key_node(kind: int, columns) -> Column:
    """A key as text, told apart from other kinds; null unless all columns
    are there. Lengths keep texts with separators apart."""
    texts = [F.col(c).cast("string") for c in as_list(columns)]
    parts = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.concat(F.lit(f"{kind}|"), *parts)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of the links (``a, b``): the least node
    that it reaches.

    Each round links a node's larger neighbours to the least one, then does
    the same among the smaller ones; links become stars after a number of
    rounds that grows with the logarithm of the longest path. Every round is
    written to the checkpoint folder. Minima are partial aggregates, and the
    joins can be split, so a node with many links is no hot task.
    """
    spark = links.sparkSession
    base = scratch_path(spark, f"identity-{uuid.uuid4().hex[:12]}")

    def written(df: DataFrame, n: int) -> DataFrame:
        df.distinct().write.parquet(f"{base}/{n}")
        return spark.read.parquet(f"{base}/{n}")

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("x").agg(F.min("y").alias("low"))

    cur, n = written(links.filter("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")), 0), 0
    while True:
        ends = cur.select(F.col("x").alias("k"), F.lit(1).alias("up")).union(cur.select("y", F.lit(0)))
        per_node = ends.groupBy("k").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("all"))
        if per_node.filter("up > 1 or up = 1 and `all` > 1").isEmpty():  # every x has one y, and that is no x
            break
        both = cur.union(cur.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = least(both).select("x", F.least("x", "low").alias("low"))
        larger = join_per_key(both.filter("y > x"), low, "x").select(F.col("y").alias("x"), F.col("low").alias("y")).distinct()
        low = least(larger)
        inner = join_per_key(larger, low, "x").filter("y <> low").select(F.col("y").alias("x"), F.col("low").alias("y"))
        nxt = written(inner.union(low.select("x", "low")), n + 1)
        remove_path(spark, f"{base}/{n}")
        cur, n = nxt, n + 1
    return cur.select(F.col("x").alias("node"), F.col("y").alias("root")).union(
        cur.select("y", "y").distinct())


def identity(df: DataFrame, keys: list, out: str = "identity") -> DataFrame:
    """``df`` with ``out``: equal for rows linked by any of the ``keys`` (each
    a column or list of columns), directly or over other rows. A key counts
    where all its columns are non-null; rows without any key get null."""
    nodes = F.array_compact(F.array(*[key_node(i, k) for i, k in enumerate(keys)]))
    rows = df.withColumn("__nodes", nodes).withColumn("__node", F.get("__nodes", F.lit(0)))
    # the first key of a row stands for it; each further one is linked to the first
    links = rows.filter(F.size("__nodes") > 1).select(
        F.col("__node").alias("a"), F.explode(F.slice("__nodes", 2, len(keys))).alias("b")).distinct()
    roots = components(links).withColumnRenamed("node", "__node").withColumnRenamed("root", "__root")
    return (join_per_key(rows, roots, "__node", "left")
            .select(*df.columns, F.coalesce("__root", "__node").alias(out)))


def keep_first_of_identity(df: DataFrame, keys: list, order, keep: str = "first", flag: str = "is_duplicate") -> DataFrame:
    """Duplicates by any of the keys: ``flag`` is true for every row of an
    identity but its first (or last) by ``order``. Rows without a key are
    duplicates of none."""
    out = identity(df, keys, "__identity")
    return flag_duplicates(out, "__identity", order, keep, flag, null_safe=False).drop("__identity")
