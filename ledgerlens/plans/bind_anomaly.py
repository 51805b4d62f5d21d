"""Anomaly rules on the driver tables (lineitem as invoice lines)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.parse import parse_tax_rate
from ledgerlens.operators import anomaly as A
from ledgerlens.operators import summary as S
from ledgerlens.plans.bind_scalars import RAW_RATE, _duck_num
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import LINE_ORDER_SQL, line_order, table

DETECTED_AT = "2024-01-01 00:00:00"

def _rates(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_tax", "l_suppkey", "l_extendedprice")
    li = li.withColumn("raw", F.expr(RAW_RATE))
    return li.withColumn("rate_num", parse_tax_rate("raw", text_to_zero=False))


_RATES_SQL = f"""r0 AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, {RAW_RATE} AS raw FROM lineitem),
r1 AS (SELECT *, trim(replace(replace(regexp_replace(trim(COALESCE(raw, '')), '%+$', ''), ',', ''), '％', '')) AS s FROM r0),
rates AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, raw, {_duck_num("s")} AS rate_num FROM r1),
anom AS (SELECT * FROM rates WHERE (rate_num IS NOT NULL AND rate_num NOT IN (13, 9, 6, 3, 0))
              OR (rate_num IS NULL AND raw NOT IN ('13','9','6','3','0','0%','0.00%','0.0%','免税','不征税','免征')))"""


@bound("tax_rate_anomaly", f"""
WITH {_RATES_SQL}
SELECT l_orderkey, l_linenumber, raw, rate_num FROM anom
""")
def tax_rate_anomaly(spark, d):
    return A.tax_rate_anomaly(_rates(spark, d), "rate_num", "raw") \
        .select("l_orderkey", "l_linenumber", "raw", "rate_num")


@bound("anomaly_by_seller", f"""
WITH {_RATES_SQL}
SELECT l_suppkey, COUNT(*) AS anomaly_count, COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS amount_sum
FROM anom GROUP BY l_suppkey
""")
def anomaly_by_seller(spark, d):
    an = A.tax_rate_anomaly(_rates(spark, d), "rate_num", "raw")
    return S.anomaly_by(an, "l_suppkey", {"amount_sum": "l_extendedprice"})


@bound("anomaly_by_rate", f"""
WITH {_RATES_SQL}
SELECT raw, COUNT(*) AS anomaly_count, COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS amount_sum
FROM anom GROUP BY raw
""")
def anomaly_by_rate(spark, d):
    an = A.tax_rate_anomaly(_rates(spark, d), "rate_num", "raw")
    return S.anomaly_by(an, "raw", {"amount_sum": "l_extendedprice"})


@bound("tax_rate_unexpected", f"""
SELECT l_orderkey, l_linenumber, rate, 'TAX_RATE_UNEXPECTED' AS anomaly_type,
       TIMESTAMP '{DETECTED_AT}' AS detected_at, year(l_shipdate) AS invoice_year
FROM (SELECT *, CASE WHEN l_linenumber = 5 THEN NULL ELSE l_tax END AS rate FROM lineitem)
WHERE NOT COALESCE(rate IN (0.13, 0.06), FALSE)
""")
def tax_rate_unexpected(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_tax", "l_shipdate")
    li = li.withColumn("rate", F.when(F.col("l_linenumber") != 5, F.col("l_tax")))
    out = A.tax_rate_unexpected(li, "rate", detected_at=DETECTED_AT, year_from="l_shipdate")
    return out.select("l_orderkey", "l_linenumber", "rate", "anomaly_type", "detected_at", "invoice_year")


# amounts: je = price, rate = l_tax, se = round(je*rate,2) (+0.05 on some), jshj = je + se (+1 on some),
# negative je on some lines, some of which belong to red invoices
_AMT = """CAST(CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2))"""
_RATE = "CAST(l_tax AS DECIMAL(4,2))"
_SE = f"""CAST(ROUND({_AMT} * {_RATE}, 2) + CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN 0.05 ELSE 0 END AS DECIMAL(18,2))"""
_TOT = f"""CAST({_AMT} + {_SE} + CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2))"""
_RED = "(l_orderkey % 26 = 0)"


@bound("amount_anomaly", f"""
WITH a AS (SELECT l_orderkey, l_linenumber, {_AMT} AS je, {_RATE} AS slv, {_SE} AS se, {_TOT} AS jshj,
                  {_RED} AS is_red FROM lineitem)
SELECT l_orderkey, l_linenumber, je, slv, se, jshj, 'tax_mismatch' AS rule FROM a
WHERE abs(se - round(je * slv, 2)) > 0.01
UNION ALL SELECT l_orderkey, l_linenumber, je, slv, se, jshj, 'total_mismatch' FROM a WHERE jshj <> je + se
UNION ALL SELECT l_orderkey, l_linenumber, je, slv, se, jshj, 'negative_amount' FROM a WHERE je < 0 AND NOT is_red
""")
def amount_anomaly(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    li = li.select("l_orderkey", "l_linenumber", F.expr(_AMT).alias("je"), F.expr(_RATE).alias("slv"),
                   F.expr(_SE).alias("se"), F.expr(_TOT).alias("jshj"), F.expr(_RED).alias("is_red"))
    return A.amount_anomaly(li, "je", "slv", "se", "jshj", is_red=F.col("is_red")).drop("is_red")


_SELLER_RATE = "CASE WHEN l_suppkey % 10 = 0 AND year(l_shipdate) >= 1999 THEN 6 ELSE 13 END"


@bound("seller_rate_inconsistent", f"""
SELECT l_suppkey, COUNT(DISTINCT {_SELLER_RATE}) AS distinct_rates, MIN(year(l_shipdate)) AS first_year,
       MAX(year(l_shipdate)) AS last_year
FROM lineitem GROUP BY l_suppkey HAVING COUNT(DISTINCT {_SELLER_RATE}) > 1
""")
def seller_rate_inconsistent(spark, d):
    li = table(spark, d, "lineitem", "l_suppkey", "l_shipdate")
    li = li.select("l_suppkey", F.expr(_SELLER_RATE).alias("rate"), F.year("l_shipdate").alias("invoice_year"))
    return A.seller_rate_inconsistent(li, "l_suppkey", "rate", "invoice_year")


@bound("similar_seller_names", """
WITH n AS (SELECT s_name AS nm, COUNT(*) AS c FROM supplier WHERE s_name IS NOT NULL GROUP BY s_name)
SELECT a.nm AS name_a, b.nm AS name_b, a.c AS rows_a, b.c AS rows_b, levenshtein(a.nm, b.nm) AS distance
FROM n a JOIN n b ON a.nm < b.nm WHERE levenshtein(a.nm, b.nm) <= 1
""")
def similar_seller_names(spark, d):
    return A.similar_names(table(spark, d, "supplier", "s_name"), "s_name", 1)


@bound("large_first_txn", f"""
SELECT l_suppkey, {", ".join(c for c in line_order() if c != "l_suppkey")}, l_orderkey, l_linenumber, amt FROM (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER_SQL}, l_orderkey, l_linenumber) AS rn
  FROM lineitem)
WHERE rn = 1 AND amt > 50000
""")
def large_first_txn(spark, d):
    li = table(spark, d, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", *line_order())
    li = li.withColumn("amt", F.col("l_extendedprice").cast("decimal(18,2)"))
    return A.first_transactions(li, "l_suppkey", line_order() + ["l_orderkey", "l_linenumber"], "amt", 50000)


@bound("month_end_concentration", """
SELECT o_custkey, COUNT(*) AS "rows",
       COUNT(*) FILTER (WHERE day(o_orderdate) > day(last_day(o_orderdate)) - 3) AS month_end_rows,
       ROUND(COUNT(*) FILTER (WHERE day(o_orderdate) > day(last_day(o_orderdate)) - 3) / COUNT(*), 4) AS ratio,
       COUNT(*) FILTER (WHERE day(o_orderdate) > day(last_day(o_orderdate)) - 3) > COUNT(*) * 0.3 AS concentrated
FROM orders GROUP BY o_custkey
""")
def month_end_concentration(spark, d):
    return A.month_end_concentration(table(spark, d, "orders", "o_custkey", "o_orderdate"),
                                     "o_custkey", "o_orderdate", 3, 0.3)


@bound("invoice_number_gaps", """
SELECT l_suppkey, prev AS gap_after, n AS next_number, n - prev - 1 AS missing FROM (
  SELECT l_suppkey, n, lag(n) OVER (PARTITION BY l_suppkey ORDER BY n) AS prev
  FROM (SELECT DISTINCT l_suppkey, l_orderkey AS n FROM lineitem))
WHERE n - prev > 1
""")
def invoice_number_gaps(spark, d):
    # bucket of 1,000 numbers so gaps across bucket edges are exercised too
    return A.number_gaps(table(spark, d, "lineitem", "l_suppkey", "l_orderkey"), "l_suppkey",
                         "l_orderkey", bucket=1000)


@bound("date_before_business", """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE CAST(o.o_orderdate AS DATE) < CAST(l.l_shipdate AS DATE)
""")
def date_before_business(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    j = li.join(o.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    return A.date_before_business(j, "o_orderdate", "l_shipdate")


@bound("price_deviation", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt,
                  CAST(l_quantity AS DECIMAL(18,2)) AS qty FROM lineitem WHERE l_quantity > 0),
s AS (SELECT l_partkey, CAST(SUM(amt) AS DECIMAL(18,2)) AS group_amount, CAST(SUM(qty) AS DECIMAL(18,2)) AS group_qty
      FROM p GROUP BY l_partkey)
SELECT p.*, s.group_amount, s.group_qty FROM p JOIN s USING (l_partkey)
WHERE s.group_amount > 0 AND abs(p.amt * s.group_qty - p.qty * s.group_amount) > 0.5 * p.qty * s.group_amount
""")
def price_deviation(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("amt"),
                   F.col("l_quantity").cast("decimal(18,2)").alias("qty"))
    return A.price_deviation(li, "l_partkey", "amt", "qty", "0.5")


@bound("monthly_rollup", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS row_count,
       COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS total_sum
FROM orders GROUP BY 1
""")
def monthly_rollup(spark, d):
    o = table(spark, d, "orders", "o_orderdate", "o_totalprice")
    return A.monthly_rollup(o, "o_orderdate", {"total_sum": "o_totalprice"})


@bound("blacklist_hits", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey FROM lineitem l
WHERE l.l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
""")
def blacklist_hits(spark, d):
    black = table(spark, d, "supplier", "s_suppkey", "s_acctbal").filter(F.col("s_acctbal") < 0)
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    return A.blacklist_hits(li, black, "l_suppkey", "s_suppkey")


# names of customers: one text for three of them, with no, one or several characters changed
_TYPO = ("CASE c_custkey % 3 WHEN 0 THEN {h} WHEN 1 THEN substr({h}, 1, 4) || substr({h}, 6, 20) "
         "ELSE 'x' || substr({h}, 1, 6) || 'y' || substr({h}, 8, 20) END")
_TYPO_SPARK = _TYPO.format(h="substr(md5(CAST(CAST(c_custkey DIV 3 AS STRING) AS BINARY)), 1, 14)")
_TYPO_DUCK = _TYPO.format(h="substr(md5(CAST(c_custkey // 3 AS VARCHAR)), 1, 14)")


@bound("similar_names_distance", f"""
WITH n AS (SELECT nm, COUNT(*) AS c FROM (SELECT {_TYPO_DUCK} AS nm FROM customer) GROUP BY nm)
SELECT a.nm AS name_a, b.nm AS name_b, a.c AS rows_a, b.c AS rows_b, levenshtein(a.nm, b.nm) AS distance
FROM n a JOIN n b ON a.nm < b.nm WHERE abs(length(a.nm) - length(b.nm)) <= 2 AND levenshtein(a.nm, b.nm) <= 2
""")
def similar_names_distance(spark, d):
    """Names of customers that two edits or fewer make equal."""
    c = table(spark, d, "customer", "c_custkey").select(F.expr(_TYPO_SPARK).alias("nm"))
    return A.similar_names(c, "nm", 2)


# sellers are suppliers, buyers customers, and a quarter of the invoices run the other way; tax ids and names are shared now and then
_PARTY = """SELECT 'S' || CAST(s_suppkey AS {t}) AS party, CASE WHEN s_suppkey % 4 = 0 THEN 'T' || CAST(s_suppkey {div} 8 AS {t}) END AS tax_id,
       CASE WHEN s_suppkey % 3 <> 1 THEN 'N' || CAST(s_suppkey {div} 5 AS {t}) END AS name FROM supplier
UNION ALL SELECT 'C' || CAST(c_custkey AS {t}), CASE WHEN c_custkey % 5 = 0 THEN 'T' || CAST(c_custkey {div} 25 AS {t}) END,
       CASE WHEN c_custkey % 6 = 2 THEN 'N' || CAST(c_custkey {div} 30 AS {t}) END FROM customer"""
_TRADE = """SELECT CASE WHEN l_linenumber % 4 = 0 THEN 'C' || CAST(o_custkey AS {t}) ELSE 'S' || CAST(l_suppkey AS {t}) END AS seller,
       CASE WHEN l_linenumber % 4 = 0 THEN 'S' || CAST(l_suppkey AS {t}) ELSE 'C' || CAST(o_custkey AS {t}) END AS buyer,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@bound("related_party_pairs", f"""
WITH p AS ({_PARTY.format(t="VARCHAR", div="//")}), t AS ({_TRADE.format(t="VARCHAR")}),
m AS (SELECT DISTINCT party, mark FROM (SELECT party, 'tax:' || tax_id AS mark FROM p UNION ALL SELECT party, 'name:' || name FROM p)
      WHERE mark IS NOT NULL),
pairs AS (SELECT seller, buyer, COUNT(*) AS invoices, SUM(amount) AS amount FROM t GROUP BY seller, buyer),
beside AS (SELECT DISTINCT a.mark AS x, b.mark AS y FROM m a JOIN m b USING (party)),
near AS (SELECT seller, buyer, min(CASE WHEN s.mark = b.mark THEN 0 ELSE 1 END) AS far
         FROM pairs JOIN m s ON s.party = seller JOIN m b ON b.party = buyer
         WHERE s.mark = b.mark OR (s.mark, b.mark) IN (SELECT (x, y) FROM beside) GROUP BY seller, buyer)
SELECT p.seller, p.buyer, p.invoices, CAST(p.amount AS DECIMAL(28,2)) AS amount, COALESCE(r.invoices, 0) AS reverse_invoices,
       CAST(COALESCE(r.amount, 0) AS DECIMAL(28,2)) AS reverse_amount, CASE far WHEN 0 THEN 'direct' ELSE 'one_between' END AS relation
FROM near JOIN pairs p USING (seller, buyer) LEFT JOIN pairs r ON r.seller = p.buyer AND r.buyer = p.seller
""")
def related_party_pairs(spark, d):
    """Trade between parties that share a tax id or name, or are one party apart."""
    from ledgerlens.operators.parties import related_party_pairs as related
    frames = {"supplier": table(spark, d, "supplier", "s_suppkey"), "customer": table(spark, d, "customer", "c_custkey"),
              "orders": table(spark, d, "orders", "o_orderkey", "o_custkey"),
              "lineitem": table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")}

    def run(q: str):
        q = q.format(t="STRING", div="DIV")
        used = {n: f for n, f in frames.items() if f" {n}" in q}
        for n in used:
            q = q.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n}", f"JOIN {{{n}}}")
        return spark.sql(q, **used)

    parties, trade = run(_PARTY), run(_TRADE)
    return related(trade, parties, "seller", "buyer", "amount", "party", ["tax_id", "name"], max_between=1)
