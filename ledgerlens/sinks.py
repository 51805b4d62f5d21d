"""Writers: the year-partitioned ledger, side tables, layer promotion.

The ledger is one parquet table partitioned by ``invoice_year``; writes
replace only the years present in the new data (dynamic partition
overwrite). Reading and overwriting the same table first cuts the lineage
with a reliable ``checkpoint()`` in the shared checkpoint folder, so the
write never reads files it is replacing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import ensure_checkpoint_dir, remove_path


def create_table(spark: SparkSession, schema, path: str, by=("invoice_year",)) -> DataFrame:
    """Create an empty parquet table with a fixed schema at ``path`` (kept as
    is when it already exists, like CREATE TABLE IF NOT EXISTS) and return it
    read with that schema."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def write_partitioned(df: DataFrame, path: str, by=("invoice_year",), mode: str = "overwrite",
                      sort_within=None, rebalance: bool = True) -> None:
    """Write parquet partitioned by ``by``; with mode 'overwrite' only the
    partitions present in ``df`` are replaced.

    Rows are rebalanced on the partition columns: AQE splits large years and
    joins small ones to tasks of the advisory size, so neither one task per
    year nor one file per task and year comes about. Without ``rebalance``
    every task writes its own rows of each year, for frames whose tasks are
    large: no row is shuffled.
    """
    by = list(by)
    out = df.hint("rebalance", *by) if by and rebalance else df
    out = out.sortWithinPartitions(*(by + list(sort_within or []))) if by or sort_within else out
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def overwrite_same_table(spark: SparkSession, df_from_table: DataFrame, path: str,
                         by=("invoice_year",), replace=None) -> None:
    """Replace partitions of the table ``df_from_table`` was read from.

    ``replace`` lists the values of the (one) partition column that the frame
    stands for: a listed partition without rows left is removed. Without it,
    only partitions that still have rows are replaced."""
    ensure_checkpoint_dir(spark)
    stable = df_from_table.checkpoint(eager=True)
    write_partitioned(stable, path, by)
    if replace is not None:
        column, = by
        left = {r[0] for r in stable.select(column).distinct().collect()}  # one row per partition
        for value in set(replace) - left:
            remove_path(spark, f"{path.rstrip('/')}/{column}={value}")


def delete_stored(spark: SparkSession, path: str, where, by: str = "invoice_year") -> DataFrame:
    """Delete the rows matching ``where`` from the stored table and return it
    read again. Only partitions that hold such rows are rewritten."""
    from pyspark.sql import functions as F
    table = spark.read.parquet(path)
    hit = F.coalesce(where, F.lit(False))
    touched = [r[0] for r in table.filter(hit).select(by).distinct().collect()]
    if touched:
        overwrite_same_table(spark, table.filter(F.col(by).isin(touched) & ~hit), path, (by,), replace=touched)
    return spark.read.schema(table.schema).parquet(path)


def promote(spark: SparkSession, src: DataFrame, dst_path: str,
            transform: Callable[[DataFrame], DataFrame] = lambda d: d, by=()) -> DataFrame:
    """Copy a layer to the next one through ``transform`` and return the
    written table (read back from ``dst_path``)."""
    out = transform(src)
    if by:
        write_partitioned(out, dst_path, by)
    else:
        out.write.mode("overwrite").parquet(dst_path)
    return spark.read.parquet(dst_path)


def table_sample(df: DataFrame, order_by, n: int = 100) -> DataFrame:
    """First ``n`` rows by ``order_by`` (a top-k plan, no full sort)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).limit(n)


def write_side_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Audit side outputs (manifest, cast stats, failures, errors): parquet,
    or csv/json with a header for people."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def export_duplicates(duplicates: DataFrame, path: str, by: str = "invoice_year") -> None:
    """Duplicate or quarantined rows for people: CSV with a header, a folder per year."""
    (duplicates.hint("rebalance", by).write.mode("overwrite").option("header", True).partitionBy(by).csv(path))


def write_error_log(errors: DataFrame, path: str) -> None:
    """Error rows enriched with remedy and category, written as CSV (with a
    header) and as JSON lines under ``path``/csv and ``path``/json."""
    from ledgerlens.operators.audit import enrich_errors
    enriched = enrich_errors(errors)
    write_side_table(enriched, f"{path}/csv", fmt="csv", mode="overwrite")
    write_side_table(enriched, f"{path}/json", fmt="json", mode="overwrite")


def describe_table(df: DataFrame) -> DataFrame:
    """Per column: type, rows, nulls, least and greatest text, from one
    pass over the rows."""
    from pyspark.sql import functions as F
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stats = df.agg(*[F.struct(F.lit(c).alias("col_name"), F.lit(k).alias("data_type"), F.count(F.lit(1)).alias("rows"),
                              F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"),
                              F.min(F.col(f"`{c}`").cast("string")).alias("min_text"),
                              F.max(F.col(f"`{c}`").cast("string")).alias("max_text")).alias(f"c{i}")
                     for i, (c, k) in enumerate(kinds.items())])
    return stats.select(F.explode(F.array(*[f"c{i}" for i in range(len(kinds))])).alias("c")).select("c.*")
