"""Dedup, quarantine, line numbers and key-set joins on the driver tables.

Detail key = (l_orderkey, l_linenumber): 60,000 lines carry 45,832 distinct
keys at sf0.01, so every duplicate path is exercised. Arrival order is a
total order over all line columns (``line_order``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import functions as L
from ledgerlens.functions import keys
from ledgerlens.operators import dedup as D
from ledgerlens.operators import identity as ID
from ledgerlens.operators import joins as J
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import LINE_ORDER_SQL, line_order, table

DKEY = ["l_orderkey", "l_linenumber"]
_LINE_COLS = ", ".join(["l_orderkey", "l_linenumber"] + line_order())
CAPTURED_AT = "2024-01-01 00:00:00"
BATCH_START = "1996-01-01"


def _lines(spark, d):
    # line 7 gets a null line number: null keys must compare equal
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", *line_order())
    return li.withColumn("l_linenumber", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")))


_LINES_SQL = f"""lines AS (SELECT l_orderkey, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS l_linenumber,
  {", ".join(line_order())} FROM lineitem)"""


@bound("dedup_detail_ledger", f"""
WITH {_LINES_SQL}
SELECT {_LINE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn FROM lines)
WHERE rn = 1
""")
def dedup_detail_ledger(spark, d):
    ledger, _ = D.build_ledger(_lines(spark, d), DKEY, line_order())
    return ledger


@bound("duplicate_detail_rows", f"""
WITH {_LINES_SQL}
SELECT {_LINE_COLS}, TIMESTAMP '{CAPTURED_AT}' AS dedup_captured_at FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn FROM lines)
WHERE rn > 1
""")
def duplicate_detail_rows(spark, d):
    _, dups = D.build_ledger(_lines(spark, d), DKEY, line_order(), captured_at=CAPTURED_AT)
    return dups


@bound("dedup_keep_last", f"""
WITH {_LINES_SQL}
SELECT {_LINE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {", ".join(c + " DESC" for c in line_order())}) AS rn FROM lines)
WHERE rn = 1
""")
def dedup_keep_last(spark, d):
    ledger, _ = D.build_ledger(_lines(spark, d), DKEY, line_order(), keep="last")
    return ledger


# header dedup on three key texts with many nulls and repeats
_HCODE = "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE '0' || lpad(CAST(o_custkey % 300 AS STRING), 11, '0') END"
_HNUM = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END"
_HENO = "CASE WHEN o_custkey % 5 = 1 THEN '2' || lpad(CAST(o_custkey % 40 AS STRING), 19, '0') END"


@bound("dedup_header_ledger", f"""
WITH h AS (SELECT o_orderkey, o_orderdate, {_HCODE} AS fpdm, {_HNUM} AS fphm, {_HENO} AS sdfphm FROM orders)
SELECT o_orderkey, o_orderdate, fpdm, fphm, sdfphm FROM (
  SELECT *, row_number() OVER (PARTITION BY fpdm, fphm, sdfphm ORDER BY o_orderdate, o_orderkey) AS rn FROM h)
WHERE rn = 1
""")
def dedup_header_ledger(spark, d):
    h = table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_custkey", "o_orderstatus")
    h = h.select("o_orderkey", "o_orderdate", F.expr(_HCODE).alias("fpdm"), F.expr(_HNUM).alias("fphm"),
                 F.expr(_HENO).alias("sdfphm"))
    ledger, _ = D.build_ledger(h, ["fpdm", "fphm", "sdfphm"], ["o_orderdate", "o_orderkey"])
    return ledger


@bound("dedup_metrics", f"""
WITH {_LINES_SQL},
f AS (SELECT year(l_shipdate) AS invoice_year,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) > 1 AS dup FROM lines)
SELECT invoice_year, COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE NOT dup) AS rows_after,
       COUNT(*) FILTER (WHERE dup) AS rows_dropped, 'detail' AS type
FROM f GROUP BY invoice_year
""")
def dedup_metrics(spark, d):
    li = _lines(spark, d).withColumn("invoice_year", F.year("l_shipdate"))
    flagged = D.flag_duplicates(li, DKEY, line_order())
    return D.dedup_metrics(flagged, "invoice_year", kind="detail")


@bound("mark_uuid_duplicates", f"""
SELECT l_orderkey, l_linenumber, {", ".join(line_order())},
  CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) > 1
       THEN 'UUID重复' END AS clean_status
FROM lineitem
""")
def mark_uuid_duplicates(spark, d):
    li = (table(spark, d, "lineitem", *DKEY, *line_order())
          .withColumn("clean_status", F.lit(None).cast("string")))
    return D.mark_uuid_duplicates(li, DKEY, line_order(), "UUID重复")


@bound("logic_line_no", f"""
SELECT l_orderkey, {", ".join(line_order())},
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS INTEGER) AS logic_line_no
FROM lineitem
""")
def logic_line_no(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", *line_order())
    return D.logic_line_no(li, "l_orderkey", line_order(), scope=())


@bound("repeated_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) >= 2
""")
def repeated_keys(spark, d):
    return D.repeated_keys(table(spark, d, "lineitem", *DKEY), DKEY)


@bound("repeated_keys_by_year", """
SELECT year(l_shipdate) AS invoice_year, l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
GROUP BY 1, l_orderkey, l_linenumber HAVING COUNT(*) >= 2
""")
def repeated_keys_by_year(spark, d):
    li = table(spark, d, "lineitem", *DKEY, "l_shipdate").withColumn("invoice_year", F.year("l_shipdate"))
    return D.repeated_keys(li, DKEY, by="invoice_year")


# ---- import batch vs. key index -------------------------------------------
# batch = lines shipped from 1996 on; the key index holds keys of earlier lines

_BATCH_SQL = f"""batch AS (SELECT l_orderkey, l_linenumber, {", ".join(line_order())} FROM lineitem
                          WHERE l_shipdate >= TIMESTAMP '{BATCH_START}'),
idx AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < TIMESTAMP '{BATCH_START}'),
cnt AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM batch GROUP BY 1, 2),
q AS (SELECT b.*, CASE WHEN EXISTS (SELECT 1 FROM idx i WHERE i.l_orderkey = b.l_orderkey AND i.l_linenumber = b.l_linenumber)
                       THEN 'already_imported'
                       WHEN c.n > 1 THEN 'repeated_in_batch' END AS quarantine_reason
      FROM batch b JOIN cnt c USING (l_orderkey, l_linenumber))"""


def _batch(spark, d):
    li = table(spark, d, "lineitem", *DKEY, *line_order())
    batch = li.filter(F.col("l_shipdate") >= F.lit(BATCH_START).cast("timestamp_ntz"))
    index = table(spark, d, "lineitem", *DKEY, "l_shipdate") \
        .filter(F.col("l_shipdate") < F.lit(BATCH_START).cast("timestamp_ntz")).select(*DKEY)
    return batch, index


@bound("quarantine_all_copies", f"""
WITH {_BATCH_SQL}
SELECT * FROM q WHERE quarantine_reason IS NOT NULL
""")
def quarantine_all_copies(spark, d):
    batch, index = _batch(spark, d)
    _, quarantined = D.quarantine(batch, DKEY, known_keys=index)
    return quarantined


@bound("new_keys_only", f"""
WITH {_BATCH_SQL}
SELECT l_orderkey, l_linenumber, {", ".join(line_order())} FROM q WHERE quarantine_reason IS NULL
""")
def new_keys_only(spark, d):
    batch, index = _batch(spark, d)
    accepted, _ = D.quarantine(batch, DKEY, known_keys=index)
    return accepted


@bound("already_imported", f"""
WITH {_BATCH_SQL}
SELECT b.* FROM batch b WHERE EXISTS (SELECT 1 FROM idx i WHERE i.l_orderkey = b.l_orderkey
                                                         AND i.l_linenumber = b.l_linenumber)
""")
def already_imported(spark, d):
    batch, index = _batch(spark, d)
    _, known = J.split_known_keys(batch, index, DKEY)
    return known


@bound("invalid_key_text", """
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' None '
             WHEN 3 THEN 'NaN' WHEN 4 THEN 'nan ' ELSE lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS k FROM orders)
SELECT o_orderkey, k FROM r
WHERE k IS NOT NULL AND lower(trim(k)) NOT IN ('', 'none', 'nan')
""")
def invalid_key_text(spark, d):
    from ledgerlens.operators.filters import valid_key_text
    raw = ("CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' None ' WHEN 3 THEN 'NaN' "
           "WHEN 4 THEN 'nan ' ELSE lpad(CAST(o_orderkey AS STRING), 8, '0') END")
    o = table(spark, d, "orders", "o_orderkey").withColumn("k", F.expr(raw))
    return valid_key_text(o, "k")


@bound("distinct_invoice_keys", """
SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem
""")
def distinct_invoice_keys(spark, d):
    return J.distinct_keys(table(spark, d, "lineitem", "l_orderkey", "l_suppkey"), ["l_orderkey", "l_suppkey"])


# ---- red invoice -> blue invoice -------------------------------------------
_KEY_OF = ("'110' || lpad(CAST({k} % 997 AS STRING), 9, '0') || lpad(CAST({k} AS STRING), 8, '0')")
_RED_REMARK = ("CASE WHEN o_orderkey % 9 = 0 AND o_orderkey >= 3 THEN '对应正数发票代码：110' || "
               "lpad(CAST((o_orderkey - 3) % 997 AS STRING), 9, '0') || '，号码：' || "
               "lpad(CAST(o_orderkey - 3 AS STRING), 8, '0') "
               "WHEN o_orderkey % 9 = 4 THEN '被红冲蓝字发票代码:9990000000 被红冲蓝字发票号码:12345678' END")


@bound("red_blue_link", f"""
WITH h AS (SELECT o_orderkey, o_totalprice, {_KEY_OF.format(k='o_orderkey')} AS invoice_key,
                  {_RED_REMARK} AS bz FROM orders),
r AS (SELECT o_orderkey, bz,
             CASE WHEN regexp_matches(bz, '{keys.BLUE_REF_CODE_AND_NUMBER}')
                  THEN regexp_extract(bz, '{keys.BLUE_REF_CODE_AND_NUMBER}', 1) ||
                       regexp_extract(bz, '{keys.BLUE_REF_CODE_AND_NUMBER}', 2)
                  WHEN regexp_matches(bz, '{keys.BLUE_REF_CODE}') AND regexp_matches(bz, '{keys.BLUE_REF_NUMBER}')
                  THEN regexp_extract(bz, '{keys.BLUE_REF_CODE}', 1) || regexp_extract(bz, '{keys.BLUE_REF_NUMBER}', 1)
             END AS related_key FROM h)
SELECT r.o_orderkey, r.related_key, b.o_orderkey AS blue_o_orderkey, b.o_totalprice AS blue_o_totalprice
FROM r LEFT JOIN h b ON r.related_key = b.invoice_key
WHERE r.related_key IS NOT NULL
""")
def red_blue_link(spark, d):
    h = table(spark, d, "orders", "o_orderkey", "o_totalprice")
    h = h.select("o_orderkey", "o_totalprice", F.expr(_KEY_OF.format(k="o_orderkey")).alias("invoice_key"),
                 F.expr(_RED_REMARK).alias("bz"))
    red = h.select("o_orderkey", L.blue_invoice_ref("bz").alias("related_key"))
    out = J.red_blue_link(red, h, "related_key", "invoice_key", blue_cols=["o_orderkey", "o_totalprice"])
    return out


@bound("year_coverage", """
WITH a AS (SELECT year(o_orderdate) AS invoice_year, COUNT(*) AS header_rows FROM orders GROUP BY 1),
b AS (SELECT year(l_shipdate) AS invoice_year, COUNT(*) AS detail_rows FROM lineitem GROUP BY 1)
SELECT COALESCE(a.invoice_year, b.invoice_year) AS invoice_year, COALESCE(header_rows, 0) AS header_rows,
       COALESCE(detail_rows, 0) AS detail_rows,
       CASE WHEN COALESCE(header_rows, 0) > 0 AND COALESCE(detail_rows, 0) > 0 THEN 'both'
            WHEN COALESCE(header_rows, 0) > 0 THEN 'only_header' ELSE 'only_detail' END AS coverage
FROM a FULL OUTER JOIN b ON a.invoice_year = b.invoice_year
""")
def year_coverage(spark, d):
    h = table(spark, d, "orders", "o_orderdate").select(F.year("o_orderdate").alias("invoice_year"))
    li = table(spark, d, "lineitem", "l_shipdate").select(F.year("l_shipdate").alias("invoice_year"))
    return J.year_coverage(h, li, "invoice_year", "header", "detail")


# ---- a hot key: a third of all lines share invoice key 0 ----------------------
_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END"


def _hot_lines(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", *line_order())
    return li.withColumn("hot_key", F.expr(_HOT))


@bound("dedup_hot_key", f"""
SELECT hot_key, l_linenumber, {", ".join(line_order())} FROM (
  SELECT *, {_HOT} AS hot_key,
         row_number() OVER (PARTITION BY {_HOT} ORDER BY {LINE_ORDER_SQL}, l_linenumber) AS rn FROM lineitem)
WHERE rn = 1
""")
def dedup_hot_key(spark, d):
    ledger, _ = D.build_ledger(_hot_lines(spark, d), "hot_key", line_order() + ["l_linenumber"],
                               columns=["hot_key", "l_linenumber", *line_order()])
    return ledger


@bound("quarantine_hot_key", f"""
WITH h AS (SELECT {_HOT} AS hot_key, l_linenumber, {", ".join(line_order())} FROM lineitem),
c AS (SELECT hot_key, COUNT(*) AS n FROM h GROUP BY hot_key)
SELECT h.*, 'repeated_in_batch' AS quarantine_reason FROM h JOIN c USING (hot_key) WHERE c.n > 1
""")
def quarantine_hot_key(spark, d):
    _, held = D.quarantine(_hot_lines(spark, d).drop("l_orderkey"), "hot_key")
    return held


@bound("detail_total_hot_key", f"""
SELECT {_HOT} AS hot_key, CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DECIMAL(18,2))
       AS detail_total_amount
FROM lineitem GROUP BY 1
""")
def detail_total_hot_key(spark, d):
    from ledgerlens.operators.quality import detail_total_per_header
    return detail_total_per_header(_hot_lines(spark, d), "hot_key", "l_extendedprice")


@bound("hot_invoice_line_numbers", f"""
SELECT l_orderkey, l_linenumber, {", ".join(line_order())}, {_HOT.replace("STRING", "VARCHAR")} AS hot_key,
       CAST(row_number() OVER (PARTITION BY {_HOT.replace("STRING", "VARCHAR")}
                               ORDER BY {LINE_ORDER_SQL}, l_linenumber, l_orderkey) AS INTEGER) AS logic_line_no
FROM lineitem
""")
def hot_invoice_line_numbers(spark, d):
    """Lines numbered across the whole batch, a third of them in one invoice."""
    return D.logic_line_no(_hot_lines(spark, d), "hot_key", [*line_order(), "l_linenumber", "l_orderkey"], scope=())


# ---- identity by either of two keys: runs of ten orders are linked link by link ----
_PRIMARY = "CASE WHEN o_orderkey % 10 <> 9 THEN CAST(o_orderkey DIV 2 AS STRING) END"
_ALTERNATIVE = "CASE WHEN o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 3 THEN CAST((o_orderkey + 1) DIV 2 AS STRING) END"


@bound("alternative_key_ledger", f"""
WITH RECURSIVE r AS (SELECT o_orderkey, o_orderdate, 'p' || {_PRIMARY.replace("STRING", "VARCHAR").replace("DIV", "//")} AS p,
                  'a' || {_ALTERNATIVE.replace("STRING", "VARCHAR").replace("DIV", "//")} AS a FROM orders),
links AS (SELECT p AS x, a AS y FROM r WHERE p IS NOT NULL AND a IS NOT NULL
          UNION SELECT a, p FROM r WHERE p IS NOT NULL AND a IS NOT NULL),
reach AS (SELECT k AS node, k AS other FROM (SELECT p AS k FROM r UNION SELECT a FROM r) WHERE k IS NOT NULL
          UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other),
low AS (SELECT node, min(other) AS root FROM reach GROUP BY node)
SELECT o_orderkey, root IS NOT NULL AND row_number() OVER (PARTITION BY root ORDER BY o_orderdate, o_orderkey) > 1 AS is_duplicate
FROM r LEFT JOIN low ON node = coalesce(p, a)
""")
def alternative_key_ledger(spark, d):
    """Duplicates by the invoice code and number or by the electronic number."""
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    o = o.withColumns({"fphm": F.expr(_PRIMARY), "sdfphm": F.expr(_ALTERNATIVE)})
    out = ID.keep_first_of_identity(o, ["fphm", "sdfphm"], ["o_orderdate", "o_orderkey"])
    return out.select("o_orderkey", "is_duplicate")


# ---- corrections of corrections, and blue invoices that come several times ----
_CORRECTS = "CASE WHEN o_orderkey % 7 <> 0 OR o_orderkey BETWEEN 1 AND 99 THEN 'K' || CAST(o_orderkey - 1 AS STRING) END"


@bound("correction_chains", f"""
WITH RECURSIVE l AS (
  SELECT k, ref FROM (SELECT k, ref, row_number() OVER (PARTITION BY k ORDER BY nth) AS n FROM (
    SELECT 'K' || CAST(o_orderkey AS VARCHAR) AS k, {_CORRECTS.replace("STRING", "VARCHAR")} AS ref, 0 AS nth FROM orders
    UNION ALL SELECT 'K' || CAST(o_orderkey AS VARCHAR), 'X', 1 FROM orders WHERE o_orderkey % 5 = 0) WHERE ref IS NOT NULL) WHERE n = 1),
walk AS (SELECT k, ref AS place, 1::BIGINT AS steps FROM l UNION ALL SELECT w.k, l.ref, w.steps + 1 FROM walk w JOIN l ON l.k = w.place)
SELECT k, arg_max(place, steps) AS first_key, max(steps) AS steps, true AS complete FROM walk GROUP BY k
""")
def correction_chains(spark, d):
    """Red invoices followed over further red ones to the first invoice; a
    fifth of the keys come twice, with another reference."""
    o = table(spark, d, "orders", "o_orderkey")
    k = F.expr("'K' || CAST(o_orderkey AS STRING)").alias("k")
    rows = o.select(k, F.expr(_CORRECTS).alias("ref"), F.lit(0).alias("nth")).union(
        o.filter("o_orderkey % 5 = 0").select(k, F.lit("X"), F.lit(1)))
    return J.correction_chains(rows, "k", "ref", ["nth"])


@bound("red_blue_first", f"""
WITH blue AS (SELECT 'K' || CAST(o_orderkey % 500 AS VARCHAR) AS k, o_orderdate, o_orderkey FROM orders),
one AS (SELECT k, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM blue GROUP BY k)
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, one.o_orderkey AS blue_o_orderkey
FROM lineitem LEFT JOIN one ON k = CASE WHEN l_orderkey % 3 = 0 THEN 'K7' ELSE 'K' || CAST(l_orderkey % 700 AS VARCHAR) END
""")
def red_blue_first(spark, d):
    """A third of the red rows refer to one blue invoice; blue keys come many times."""
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    blue = o.withColumn("k", F.expr("'K' || CAST(o_orderkey % 500 AS STRING)"))
    red = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate").withColumn(
        "ref", F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 'K7' ELSE 'K' || CAST(l_orderkey % 700 AS STRING) END"))
    out = J.red_blue_link(red, blue, "ref", "k", blue_cols=["o_orderkey"], blue_order=["o_orderdate", "o_orderkey"])
    return out.drop("ref")
