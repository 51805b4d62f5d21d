"""Routing of sheets to target tables.

A sheet goes where its name says (``PREFIX__…``), else to the target that
shares most titles with it, else to the transit table, where its rows wait
with all their values. Every sheet goes to exactly one table, so no row is
lost or loaded twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import path_exists
from ledgerlens.sources import xlsx

# fixed values: separator of a prefix, and the prefixes that mean the transit table
DELIMITER = "__"
TRANSIT_PREFIXES = ("TEMP_TRANSIT", "TEMP")
TRANSIT = "transit"


def _by_prefix(name: Column, targets: list[str], delimiter: str, transit: str) -> Column:
    """The target named by the text before the delimiter: the one of that
    name, else the first one whose name ends with it; null if none does."""
    prefix = F.upper(F.trim(F.substring_index(name, delimiter, 1)))
    named = F.when(prefix.isin(*TRANSIT_PREFIXES), F.lit(transit))
    for t in targets:
        named = named.when(prefix == t.upper(), F.lit(t))
    for t in targets:
        named = named.when((prefix != "") & F.lit(t.upper()).endswith(prefix), F.lit(t))
    return F.when(F.instr(name, delimiter) > 0, named)


def route_sheets(catalogue: DataFrame, schemas: dict[str, list[str]], name: str = "sheet", columns: str = "columns",
                 min_overlap: int = 1, delimiter: str = DELIMITER, transit: str = TRANSIT) -> DataFrame:
    """``catalogue`` (one row per sheet) with ``target_table``, ``route``
    ('prefix', 'overlap' or 'transit') and ``overlap``, the number of titles
    shared with the target (of equal ones the first target in ``schemas``)."""
    targets = list(schemas)
    shared = {t: F.size(F.array_intersect(F.coalesce(F.col(columns), F.array().cast("array<string>")),
                                          F.array(*[F.lit(c) for c in dict.fromkeys(schemas[t])]))) for t in targets}
    # the greatest (overlap, earlier target)
    best = F.greatest(*[F.struct(shared[t].alias("n"), F.lit(-i).alias("i")) for i, t in enumerate(targets)]) \
        if len(targets) > 1 else F.struct(shared[targets[0]].alias("n"), F.lit(0).alias("i"))
    named = _by_prefix(F.col(name), targets, delimiter, transit)
    out = catalogue.withColumns({"__named": named, "__best": best})
    by_overlap = F.element_at(F.array(*[F.lit(t) for t in targets]), 1 - F.col("__best.i"))
    enough = F.col("__best.n") >= min_overlap
    target = F.when(F.col("__named").isNotNull(), F.col("__named")).when(enough, by_overlap).otherwise(F.lit(transit))
    route = F.when(F.col("__named").isNotNull(), "prefix").when(enough, "overlap").otherwise("transit")
    out = out.withColumns({"target_table": target, "route": route})
    overlap = F.lit(0)
    for t in targets:
        overlap = F.when(F.col("target_table") == t, shared[t]).otherwise(overlap)
    return out.withColumn("overlap", overlap).drop("__named", "__best")


def write_routed(rows: DataFrame, routed: DataFrame, schemas: dict[str, list[str]], path: str, batch_id: str) -> dict[str, str]:
    """Append the data rows of routed sheets to ``path/<target>``, each with
    its target's columns as text (absent titles null), and to ``path/transit``
    with the values by title. Returns the folders that have rows.

    Rows are dealt to their targets in one partitioned write; each target is
    then read as its partition alone. Every table is partitioned by
    ``import_batch_id``, and a batch that is written again replaces itself.
    """
    spark = rows.sparkSession
    dealt = f"{path.rstrip('/')}/_dealt"
    sheets = routed.select("file", "sheet", "target_table", "route")
    data = xlsx.data_rows(rows).select("file", "sheet", "row_no", "values").join(sheets, ["file", "sheet"])
    (data.withColumn("import_batch_id", F.lit(batch_id)).hint("rebalance", "target_table")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("import_batch_id", "target_table").parquet(dealt))
    out = {}
    for target in [*schemas, *sorted({TRANSIT} - set(schemas))]:
        folder = f"{dealt}/import_batch_id={batch_id}/target_table={target}"
        if not path_exists(spark, folder):
            continue
        part = spark.read.parquet(folder)
        place = [F.col("file").alias("source_file"), F.col("sheet").alias("source_sheet"), "row_no", "route"]
        values = ([F.col("values").getItem(c).alias(c) for c in dict.fromkeys(schemas[target])] if target in schemas
                  else [F.col("values")])
        out[target] = f"{path.rstrip('/')}/{target}"
        (part.select(*place, *values, F.lit(batch_id).alias("import_batch_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("import_batch_id").parquet(out[target]))
    return out


def import_routed(spark: SparkSession, folder: str, path: str, schemas: dict[str, list[str]], batch_id: str,
                  staged: str, min_overlap: int = 1, max_mb: float | None = 500.0):
    """Read all workbooks under ``folder`` (staged once at ``staged``), route
    their sheets and append the rows to their targets under ``path``. Returns
    the routed catalogue, the folders written and the error rows."""
    rows = xlsx.stage_workbooks(spark, folder, staged, max_mb=max_mb)
    routed = route_sheets(xlsx.sheet_catalogue(rows), schemas, min_overlap=min_overlap)
    return routed, write_routed(rows, routed, schemas, path, batch_id), xlsx.error_rows(rows)
