"""Aggregations and profiles on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import summary as S
from ledgerlens.plans.bind_scalars import RAW_DATE_TEXT, RAW_YEAR
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import table

_TAX = "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))"


@bound("year_summary", f"""
SELECT year(l_shipdate) AS invoice_year, COUNT(1) AS row_count,
       COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS amount_sum,
       COALESCE(SUM({_TAX}), 0) AS tax_sum
FROM lineitem GROUP BY 1
""")
def year_summary(spark, d):
    li = table(spark, d, "lineitem", "l_shipdate", "l_extendedprice", "l_tax")
    li = li.select(F.year("l_shipdate").alias("invoice_year"),
                   F.col("l_extendedprice").cast("decimal(18,2)").alias("je"), F.expr(_TAX).alias("se"))
    return S.year_summary(li, "invoice_year", {"amount_sum": "je", "tax_sum": "se"}, dtype=None)


@bound("count_where", """
SELECT COUNT(*) AS row_count FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25
""")
def count_where(spark, d):
    li = table(spark, d, "lineitem", "l_returnflag", "l_quantity")
    return S.count_by(li, where=(F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25))


@bound("count_by_year", """
SELECT COUNT(*) AS row_count FROM lineitem WHERE year(l_shipdate) = 1997
""")
def count_by_year(spark, d):
    li = table(spark, d, "lineitem", "l_shipdate")
    # a date range reaches the scan; year() of the column would not
    return S.count_by(li, where=F.col("l_shipdate").between(F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"),
                                                            F.lit("1997-12-31 23:59:59.999999").cast("timestamp_ntz")))


@bound("count_by_status", """
SELECT o_orderstatus, COUNT(*) AS row_count FROM orders GROUP BY o_orderstatus
""")
def count_by_status(spark, d):
    return S.count_by(table(spark, d, "orders", "o_orderstatus"), "o_orderstatus")


@bound("distinct_years", f"""
SELECT DISTINCT raw AS invoice_year FROM (SELECT {RAW_YEAR} AS raw FROM orders)
WHERE raw IS NOT NULL AND regexp_full_match(raw, '\\d+')
""")
def distinct_years(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate").select(F.expr(RAW_YEAR).alias("raw"))
    return S.distinct_years(o, "raw")


@bound("year_distribution", """
SELECT year(o_orderdate) AS invoice_year, COUNT(*) AS row_count FROM orders GROUP BY 1
""")
def year_distribution(spark, d):
    o = table(spark, d, "orders", "o_orderdate").select(F.year("o_orderdate").alias("invoice_year"))
    return S.year_distribution(o, "invoice_year")


@bound("distinct_format_count", f"""
SELECT COUNT(DISTINCT raw) AS distinct_values, 5 AS expected, COUNT(DISTINCT raw) <> 5 AS mixed_format
FROM (SELECT {RAW_YEAR} AS raw FROM orders)
""")
def distinct_format_count(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate").select(F.expr(RAW_YEAR).alias("raw"))
    return S.distinct_format_count(o, "raw", 5)


_YEARS = list(range(1995, 2002))


@bound("conditional_year_counts", f"""
SELECT {", ".join(f"COUNT(*) FILTER (WHERE substr(raw, 1, 4) = '{y}') AS y{y}" for y in _YEARS)},
       COUNT(*) FILTER (WHERE raw IS NULL) AS null_count, COUNT(*) AS total
FROM (SELECT {RAW_DATE_TEXT} AS raw FROM orders)
""")
def conditional_year_counts(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate").select(F.expr(RAW_DATE_TEXT).alias("raw"))
    return S.conditional_year_counts(o, "raw", _YEARS)


@bound("format_profile", f"""
SELECT raw AS value, COUNT(*) AS row_count, length(raw) AS value_length,
       CASE WHEN raw IS NULL THEN 'null' WHEN regexp_full_match(raw, '\\d{{4}}') THEN 'four_digits'
            WHEN contains(raw, '.') THEN 'has_dot' ELSE 'other' END AS pattern
FROM (SELECT {RAW_YEAR} AS raw FROM orders) GROUP BY raw
""")
def format_profile(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate").select(F.expr(RAW_YEAR).alias("raw"))
    return S.format_profile(o, "raw")


@bound("quality_report", """
WITH u AS (SELECT TRUE AS h, year(o_orderdate) AS invoice_year FROM orders
           UNION ALL SELECT FALSE, year(l_shipdate) FROM lineitem),
r AS (SELECT invoice_year, GROUPING(invoice_year) = 1 AS is_total,
             COUNT(*) FILTER (WHERE h) AS header_rows, COUNT(*) FILTER (WHERE NOT h) AS detail_rows
      FROM u GROUP BY ROLLUP (invoice_year))
SELECT invoice_year, is_total, header_rows, detail_rows,
       ROUND(CASE WHEN header_rows > 0 THEN detail_rows / header_rows END, 4) AS detail_per_header,
       CASE WHEN is_total AND detail_rows = 0 THEN 'ERROR' WHEN is_total AND header_rows = 0 THEN 'ERROR'
            WHEN is_total AND header_rows > 0 AND (detail_rows / header_rows < 1 OR detail_rows / header_rows > 100)
            THEN 'WARNING' END AS issue_level,
       CASE WHEN is_total AND (detail_rows = 0 OR header_rows = 0 OR detail_rows / header_rows < 1
                               OR detail_rows / header_rows > 100)
            THEN concat_ws('; ', CASE WHEN detail_rows = 0 THEN 'ODS 明细表为空' END,
                           CASE WHEN header_rows = 0 THEN 'ODS 表头表为空' END,
                           CASE WHEN header_rows > 0 AND (detail_rows / header_rows < 1 OR detail_rows / header_rows > 100)
                                THEN '明细/表头比例异常: ' || printf('%.1f', detail_rows / header_rows) END) END AS issue_message
FROM r
""")
def quality_report(spark, d):
    h = table(spark, d, "orders", "o_orderdate").select(F.year("o_orderdate").alias("invoice_year"))
    li = table(spark, d, "lineitem", "l_shipdate").select(F.year("l_shipdate").alias("invoice_year"))
    return S.quality_report(h, li, "invoice_year")


@bound("table_rowcounts", """
SELECT 'header' AS table_name, year(o_orderdate) AS invoice_year, COUNT(*) AS row_count, TRUE AS has_data
FROM orders GROUP BY 2
UNION ALL
SELECT 'detail', year(l_shipdate), COUNT(*), TRUE FROM lineitem GROUP BY 2
""")
def table_rowcounts(spark, d):
    h = table(spark, d, "orders", "o_orderdate").select(F.year("o_orderdate").alias("invoice_year"))
    li = table(spark, d, "lineitem", "l_shipdate").select(F.year("l_shipdate").alias("invoice_year"))
    return S.table_rowcounts({"header": h, "detail": li}, by="invoice_year")


@bound("list_years", """
SELECT DISTINCT year(o_orderdate) AS invoice_year FROM orders
WHERE year(o_orderdate) IN (SELECT year(l_shipdate) FROM lineitem)
""")
def list_years(spark, d):
    # years that have both a header and a detail partition
    h = table(spark, d, "orders", "o_orderdate").select(F.year("o_orderdate").alias("invoice_year")).distinct()
    li = table(spark, d, "lineitem", "l_shipdate").select(F.year("l_shipdate").alias("invoice_year")).distinct()
    return h.join(li, "invoice_year", "left_semi")
