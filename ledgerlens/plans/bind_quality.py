"""Reconciliation queries: detail totals, balance status, orphans, DQ pass."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens import ingest, sinks
from ledgerlens.operators import quality as Q
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import LINE_ORDER_SQL, line_order, money, table
from ledgerlens.session import scratch_path

CHECKED_AT = "2024-01-01 00:00:00"
CHECKED_BY = "ledgerlens.dq"


def _balance_header(spark, d):
    """orders with their line totals attached once; the header total is the
    line sum plus 0/.05/.10/.15, some tolerances are overridden, some states
    are manual and some rows are already flagged."""
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice")
    li = table(spark, d, "lineitem", "l_orderkey", "l_extendedprice")
    totals = Q.detail_total_per_header(li, "l_orderkey", "l_extendedprice") \
        .withColumnRenamed("l_orderkey", "o_orderkey")
    k = F.col("o_orderkey")
    return (o.join(totals, "o_orderkey", "left")
            .select(
                "o_orderkey", "detail_total_amount",
                money(F.coalesce(F.col("detail_total_amount"), money("o_totalprice"))
                      + (k % 4) * F.lit(0.05).cast("decimal(3,2)")).alias("jshj"),
                F.when(k % 10 == 3, F.lit(0.20).cast("decimal(18,2)")).alias("balance_tolerance"),
                F.when(k % 50 == 7, F.lit("强制通过")).otherwise(F.lit("未校验")).alias("is_balanced"),
                F.when(k % 97 == 5, F.lit("明细缺失")).alias("clean_status")))


@bound("balance_check", """
WITH t AS (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS s
           FROM lineitem GROUP BY l_orderkey),
h AS (SELECT o.o_orderkey,
        CAST(COALESCE(t.s, CAST(o.o_totalprice AS DECIMAL(18,2))) + (o.o_orderkey % 4) * 0.05 AS DECIMAL(18,2)) AS jshj,
        t.s AS detail_total_amount,
        CASE WHEN o.o_orderkey % 10 = 3 THEN CAST(0.20 AS DECIMAL(18,2)) END AS tol,
        CASE WHEN o.o_orderkey % 50 = 7 THEN '强制通过' ELSE '未校验' END AS st,
        CASE WHEN o.o_orderkey % 97 = 5 THEN '明细缺失' END AS cs
      FROM orders o LEFT JOIN t ON t.l_orderkey = o.o_orderkey),
c AS (SELECT *, ABS(detail_total_amount - jshj) AS diff, (cs IS NULL AND st = '未校验') AS elig FROM h)
SELECT o_orderkey, jshj, detail_total_amount,
       CASE WHEN elig THEN CAST(diff AS DECIMAL(18,2)) END AS balance_diff,
       CASE WHEN elig AND diff = 0 THEN '平账'
            WHEN elig AND diff > 0 AND diff <= COALESCE(tol, 0.1) THEN '差异可接受'
            WHEN elig AND diff > COALESCE(tol, 0.1) THEN '不平账'
            ELSE st END AS is_balanced,
       CASE WHEN elig AND diff IS NOT NULL THEN 'ledgerlens.dq' END AS balance_check_by
FROM c
""")
def balance_check(spark, d):
    out = Q.balance_check(_balance_header(spark, d), None, "o_orderkey",
                          checked_at=CHECKED_AT, checked_by=CHECKED_BY)
    return out.select("o_orderkey", "jshj", "detail_total_amount", "balance_diff",
                      "is_balanced", "balance_check_by")


@bound("detail_total_per_header", """
SELECT l_orderkey, CAST(COALESCE(SUM(CAST(CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_extendedprice END
                                          AS DECIMAL(18,2))), 0) AS DECIMAL(28,2)) AS detail_total_amount
FROM lineitem GROUP BY l_orderkey
""")
def detail_total_per_header(spark, d):
    # every third line has a null amount, so all-null groups must sum to 0
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    li = li.withColumn("amt", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_extendedprice")))
    return Q.detail_total_per_header(li, "l_orderkey", "amt")


# a key that no order has, for the lines of some orders
_LINE_KEY = "CASE WHEN l_orderkey % 11 = 4 THEN -l_orderkey - 1 ELSE l_orderkey END"


@bound("orphan_details", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT -l_orderkey - 1 AS l_orderkey, l_linenumber, l_extendedprice
  FROM lineitem WHERE l_orderkey % 11 = 4 UNION ALL
  SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey % 11 <> 4) l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
""")
def orphan_details(spark, d):
    # the lines of some orders carry a key that no order has
    h = table(spark, d, "orders", "o_orderkey")
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    li = li.withColumn("l_orderkey", F.expr(_LINE_KEY))
    return Q.orphans(li, h, "l_orderkey", right_key="o_orderkey")


@bound("headers_without_detail", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def headers_without_detail(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, d, "lineitem", "l_orderkey")
    return Q.orphans(o, li, "o_orderkey", right_key="l_orderkey")


def _dq_inputs(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    header = o.select(
        F.col("o_orderkey").alias("header_uuid"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(None).cast("string").alias("clean_status"),
        F.when(k % 50 == 7, F.lit("强制通过")).otherwise(F.lit("未校验")).alias("is_balanced"),
        F.lit(None).cast("decimal(18,2)").alias("balance_tolerance"),
        money("o_totalprice").alias("jshj"))
    li = table(spark, d, "lineitem")
    detail = li.select(
        F.expr(_LINE_KEY).alias("header_uuid"), "l_linenumber", *line_order(),
        F.lit(None).cast("string").alias("clean_status"),
        money("l_extendedprice").alias("jshj"))
    return header, detail


_DQ_SQL_PREFIX = f"""
WITH h0 AS (SELECT o_orderkey AS header_uuid, o_orderdate AS created_at,
                   CASE WHEN o_orderkey % 50 = 7 THEN '强制通过' ELSE '未校验' END AS st,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS jshj
            FROM orders),
h1 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY header_uuid ORDER BY created_at) > 1
                      THEN 'UUID重复' END AS cs FROM h0),
d1 AS (SELECT {_LINE_KEY} AS header_uuid, l_linenumber, {LINE_ORDER_SQL},
              CAST(l_extendedprice AS DECIMAL(18,2)) AS jshj,
              CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) > 1
                   THEN 'UUID重复' END AS cs FROM lineitem),
d2 AS (SELECT d1.*, CASE WHEN cs IS NULL AND header_uuid NOT IN (SELECT header_uuid FROM h1 WHERE cs IS NULL)
                         THEN '主表缺失' ELSE cs END AS clean_status FROM d1),
h2 AS (SELECT h1.*, CASE WHEN cs IS NULL AND header_uuid NOT IN (SELECT header_uuid FROM d1 WHERE cs IS NULL)
                         THEN '明细缺失' ELSE cs END AS clean_status FROM h1),
t AS (SELECT header_uuid, CAST(SUM(jshj) AS DECIMAL(18,2)) AS detail_total_amount FROM d1 GROUP BY header_uuid),
h3 AS (SELECT h2.*, t.detail_total_amount, ABS(t.detail_total_amount - h2.jshj) AS diff,
              (h2.clean_status IS NULL AND h2.st = '未校验') AS elig
       FROM h2 LEFT JOIN t USING (header_uuid)),
h4 AS (SELECT header_uuid, jshj, clean_status, detail_total_amount,
              CASE WHEN elig THEN CAST(diff AS DECIMAL(18,2)) END AS balance_diff,
              CASE WHEN elig AND diff = 0 THEN '平账'
                   WHEN elig AND diff > 0 AND diff <= 0.1 THEN '差异可接受'
                   WHEN elig AND diff > 0.1 THEN '不平账' ELSE st END AS is_balanced
       FROM h3)
"""


@bound("dq_header", _DQ_SQL_PREFIX + """
SELECT header_uuid, jshj, clean_status, detail_total_amount, balance_diff, is_balanced FROM h4
""")
def dq_header(spark, d):
    header, detail = _dq_inputs(spark, d)
    h, _ = Q.run_dq(header, detail, header_key="header_uuid",
                    detail_key=["header_uuid", "l_linenumber"], link_key="header_uuid",
                    header_order=["created_at"], detail_order=line_order())
    return h.select("header_uuid", "jshj", "clean_status", "detail_total_amount",
                    "balance_diff", "is_balanced")


@bound("dq_detail", _DQ_SQL_PREFIX + f"""
SELECT header_uuid, l_linenumber, {LINE_ORDER_SQL}, jshj, clean_status FROM d2
""")
def dq_detail(spark, d):
    header, detail = _dq_inputs(spark, d)
    _, dd = Q.run_dq(header, detail, header_key="header_uuid",
                     detail_key=["header_uuid", "l_linenumber"], link_key="header_uuid",
                     header_order=["created_at"], detail_order=line_order())
    return dd.select("header_uuid", "l_linenumber", *line_order(), "jshj", "clean_status")


@bound("dq_issue_counts", _DQ_SQL_PREFIX + """
SELECT 'header' AS table_name, 'clean_status' AS field, COALESCE(clean_status, '') AS value, COUNT(*) AS "rows"
FROM h4 GROUP BY 3
UNION ALL
SELECT 'header', 'is_balanced', COALESCE(is_balanced, ''), COUNT(*) FROM h4 GROUP BY 3
UNION ALL
SELECT 'detail', 'clean_status', COALESCE(clean_status, ''), COUNT(*) FROM d2 GROUP BY 3
""")
def dq_issue_counts(spark, d):
    header, detail = _dq_inputs(spark, d)
    h, dd = Q.run_dq(header, detail, header_key="header_uuid",
                     detail_key=["header_uuid", "l_linenumber"], link_key="header_uuid",
                     header_order=["created_at"], detail_order=line_order())
    return Q.issue_counts(h, dd)


@bound("dq_write_back", _DQ_SQL_PREFIX + """
SELECT header_uuid, jshj, clean_status, detail_total_amount, balance_diff, is_balanced FROM h4
""")
def dq_write_back(spark, d):
    """The quality pass over stored ledgers, its flags written back and read again."""
    header, detail = _dq_inputs(spark, d)
    base = scratch_path(spark, f"dq-{uuid.uuid4().hex[:12]}")
    for frame, date, name in ((header, "created_at", "header"), (detail, "l_shipdate", "detail")):
        sinks.write_partitioned(frame.withColumn("invoice_year", F.year(date)), f"{base}/{name}", rebalance=False)
    h, _ = ingest.check_quality(spark, f"{base}/header", f"{base}/detail", CHECKED_AT, CHECKED_BY,
                                header_key="header_uuid", detail_key=["header_uuid", "l_linenumber"],
                                link_key="header_uuid", header_order=["created_at"], detail_order=line_order())
    return h.select("header_uuid", "jshj", "clean_status", "detail_total_amount", "balance_diff", "is_balanced")
