"""Aggregations and profiles: year summaries, counts, format profiles,
quality report. Each report is one aggregation pass (``count_if`` per
condition), never one job per year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import as_list


def _sum(c: str, dtype: str | None) -> Column:
    """Null-safe sum in the width Spark gives it (10 digits more than the input)."""
    v = F.col(c).cast(dtype) if dtype else F.col(c)
    return F.coalesce(F.sum(v), F.lit(0))


def year_summary(df: DataFrame, year: str, sums: dict[str, str], dtype="decimal(18,2)") -> DataFrame:
    """Per year (null included): row count and null-safe sums (all-null sum
    -> 0); ``dtype`` None sums the columns as they are typed."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for out, c in sums.items():
        aggs.append(_sum(c, dtype).alias(out))
    return df.groupBy(year).agg(*aggs)


def count_by(df: DataFrame, *cols: str, where: Column | None = None, out: str = "row_count") -> DataFrame:
    """Row count, optionally filtered, optionally per group (no cols -> one row)."""
    d = df.filter(where) if where is not None else df
    return d.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def distinct_years(df: DataFrame, year: str, out: str = "invoice_year") -> DataFrame:
    """Distinct year values that are non-null and all digits."""
    y = F.col(year).cast("string")
    return (df.select(y.alias(out)).filter(F.col(out).isNotNull() & F.col(out).rlike(r"^\d+$"))
            .distinct().orderBy(out))


def year_distribution(df: DataFrame, year: str, out: str = "row_count") -> DataFrame:
    return df.groupBy(year).agg(F.count(F.lit(1)).alias(out))


def distinct_format_count(df: DataFrame, col: str, expected: int) -> DataFrame:
    """Number of distinct values of ``col`` and whether it differs from ``expected``."""
    return df.agg(F.count_distinct(F.col(col)).alias("distinct_values")) \
        .withColumn("expected", F.lit(expected)) \
        .withColumn("mixed_format", F.col("distinct_values") != F.col("expected"))


def conditional_year_counts(df: DataFrame, date_text: str, years) -> DataFrame:
    """One row: per year the count of rows whose text starts with that year,
    plus the count of null texts."""
    s = F.col(date_text).cast("string")
    aggs = [F.count_if(F.substring(s, 1, 4) == str(y)).alias(f"y{y}") for y in years]
    aggs.append(F.count_if(s.isNull()).alias("null_count"))
    aggs.append(F.count(F.lit(1)).alias("total"))
    return df.agg(*aggs)


def format_profile(df: DataFrame, col: str) -> DataFrame:
    """Per raw value: its length, pattern class and row count.

    Classes: 'null', 'four_digits' (``____`` of digits), 'has_dot'
    (``%.%``), 'other'.
    """
    v = F.col("value")
    cls = (F.when(v.isNull(), "null")
           .when(v.rlike(r"^\d{4}$"), "four_digits")
           .when(v.contains("."), "has_dot")
           .otherwise("other"))
    return (df.groupBy(F.col(col).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .withColumns({"value_length": F.length(v), "pattern": cls}))


def table_rowcounts(frames: dict[str, DataFrame], by: str | None = None) -> DataFrame:
    """Row count per named table, and per ``by`` value, with a has-data flag.
    With ``by``, an empty table has one row (null ``by``, 0 rows)."""
    parts = []
    for name, df in frames.items():
        total = df.agg(F.count(F.lit(1)).alias("row_count"))  # a row for an empty table too
        if by:
            each = df.groupBy(F.col(by)).agg(F.count(F.lit(1)).alias("row_count"))
            kind = df.schema[by].dataType
            total = each.unionByName(total.filter("row_count = 0").withColumn(by, F.lit(None).cast(kind)))
        parts.append(total.select(F.lit(name).alias("table_name"), *([by] if by else []), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("has_data", F.col("row_count") > 0)


# fixed values: quality report messages
EMPTY_DETAIL_MSG = "ODS 明细表为空"
EMPTY_HEADER_MSG = "ODS 表头表为空"
RATIO_MSG = "明细/表头比例异常: "


def quality_report(header: DataFrame, detail: DataFrame, year: str, lo: float = 1.0,
                   hi: float = 100.0) -> DataFrame:
    """Row counts per year and in total for header and detail, with issues.

    Counts per year, and their sum as the total row, which is there for empty
    tables too. The total row (``is_total``) carries
    the issues: ERROR when a table is empty, WARNING when detail/header lies
    outside [lo, hi] (several issues are joined with '; ').
    """
    u = (header.select(F.lit(True).alias("__h"), F.col(year))
         .unionByName(detail.select(F.lit(False).alias("__h"), F.col(year))))
    counts = [F.coalesce(F.count_if(F.col("__h")), F.lit(0)).alias("header_rows"),
              F.coalesce(F.count_if(~F.col("__h")), F.lit(0)).alias("detail_rows")]
    each = u.groupBy(year).agg(*counts).withColumn("__g", F.lit(0))
    total_row = each.agg(F.coalesce(F.sum("header_rows"), F.lit(0)).alias("header_rows"),
                         F.coalesce(F.sum("detail_rows"), F.lit(0)).alias("detail_rows"))
    kind = each.schema[year].dataType
    r = each.unionByName(total_row.select(F.lit(None).cast(kind).alias(year), "header_rows", "detail_rows",
                                          F.lit(1).alias("__g")))
    hr, dr, total = F.col("header_rows"), F.col("detail_rows"), F.col("__g") == 1
    ratio = F.when(hr > 0, dr / hr)
    e_detail = F.when(total & (dr == 0), F.lit("ERROR"))
    e_header = F.when(total & (hr == 0), F.lit("ERROR"))
    w_ratio = F.when(total & (hr > 0) & ((ratio < lo) | (ratio > hi)), F.lit("WARNING"))
    message = F.concat_ws("; ",
                          F.when(e_detail.isNotNull(), F.lit(EMPTY_DETAIL_MSG)),
                          F.when(e_header.isNotNull(), F.lit(EMPTY_HEADER_MSG)),
                          F.when(w_ratio.isNotNull(), F.concat(F.lit(RATIO_MSG), F.format_string("%.1f", ratio))))
    level = F.coalesce(e_detail, e_header, w_ratio)
    return r.select(F.col(year), total.alias("is_total"), hr, dr,
                    F.round(ratio, 4).alias("detail_per_header"),
                    level.alias("issue_level"),
                    F.when(level.isNotNull(), message).alias("issue_message"))


def anomaly_by(df: DataFrame, by, sums: dict[str, str], dtype="decimal(18,2)") -> DataFrame:
    """Count and sums per group, for drill-downs (ordered by count desc)."""
    aggs = [F.count(F.lit(1)).alias("anomaly_count")]
    for out, c in sums.items():
        aggs.append(_sum(c, dtype).alias(out))
    return df.groupBy(*as_list(by)).agg(*aggs).orderBy(F.desc("anomaly_count"), *as_list(by))
