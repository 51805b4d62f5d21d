"""Lookups and table maintenance through the column API.

Predicates are Column expressions (or SQL with bound parameters via
``spark.sql(..., args=...)``); no SQL text is spliced from values. On a
table partitioned by ``invoice_year`` a year predicate prunes partitions,
and on parquet the other predicates are pushed into the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.joins import as_list


def find_where(df: DataFrame, predicate: Column | None = None, order_by=None,
               limit: int | None = None) -> DataFrame:
    """Filter, then optionally order and keep the first ``limit`` rows
    (order + limit plans as a top-k, no full sort)."""
    out = df.filter(predicate) if predicate is not None else df
    if order_by is not None:
        out = out.orderBy(*as_list(order_by)) if isinstance(order_by, (str, list, tuple)) \
            else out.orderBy(order_by)
    if limit:
        out = out.limit(limit)
    return out


def lookup(df: DataFrame, values: dict, order_by=None, limit: int | None = None) -> DataFrame:
    """Rows where every ``column == value`` in ``values``."""
    pred = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in values.items()])
    return find_where(df, pred, order_by, limit)


def lookup_many(df: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys_df`` (semi join; Spark broadcasts
    the key list when its size in bytes allows)."""
    return df.join(keys_df.select(*as_list(on)).distinct(), as_list(on), "left_semi")


def param_sql(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run read-only SQL with bound parameters (``:name``) over named frames
    (``{name}`` placeholders)."""
    return spark.sql(query, args=args or {}, **frames)


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
