"""Lookups, parameterised SQL, delete and union on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import filters as FL
from ledgerlens.operators import lookup as LK
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import LINE_ORDER_SQL, line_order, table


@bound("find_where", """
SELECT * FROM orders WHERE o_totalprice > 400000 AND o_orderpriority = '1-URGENT'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def find_where(spark, d):
    o = table(spark, d, "orders")
    return LK.find_where(o, (F.col("o_totalprice") > 400000) & (F.col("o_orderpriority") == "1-URGENT"),
                         [F.desc("o_totalprice"), F.asc("o_orderkey")], 100)


@bound("find_all_sorted", f"""
SELECT * FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, {LINE_ORDER_SQL} LIMIT 50
""")
def find_all_sorted(spark, d):
    li = table(spark, d, "lineitem")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")] + \
        [F.asc(c) for c in line_order()]
    return LK.find_where(li, None, order, 50)


@bound("find_by_id", """
SELECT * FROM orders WHERE o_orderkey = 42
""")
def find_by_id(spark, d):
    return LK.lookup(table(spark, d, "orders"), {"o_orderkey": 42})


@bound("find_by_invoice", """
SELECT * FROM orders WHERE o_custkey = 899 AND o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 1
""")
def find_by_invoice(spark, d):
    return LK.lookup(table(spark, d, "orders"), {"o_custkey": 899, "o_orderstatus": "P"},
                     order_by="o_orderkey", limit=1)


@bound("find_by_year", """
SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
""")
def find_by_year(spark, d):
    # a range on the date (not year(date) = y) so the predicate reaches the scan
    li = table(spark, d, "lineitem")
    return LK.find_where(li, (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                         & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")))


@bound("find_by_seller", """
SELECT * FROM lineitem WHERE l_suppkey = 7
""")
def find_by_seller(spark, d):
    return LK.lookup(table(spark, d, "lineitem"), {"l_suppkey": 7}, order_by=["l_shipdate"] + ["l_orderkey"])


@bound("find_by_buyer", """
SELECT * FROM orders WHERE o_custkey = 100
""")
def find_by_buyer(spark, d):
    return LK.lookup(table(spark, d, "orders"), {"o_custkey": 100}, order_by="o_orderdate")


@bound("lookup_many", """
SELECT l.* FROM lineitem l WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def lookup_many(spark, d):
    keys = (table(spark, d, "orders", "o_orderkey", "o_orderpriority")
            .filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey")))
    return LK.lookup_many(table(spark, d, "lineitem"), keys, "l_orderkey")


@bound("anomalies_by_type", """
SELECT * FROM events WHERE event_type = 'error'
""")
def anomalies_by_type(spark, d):
    return LK.lookup(table(spark, d, "events"), {"event_type": "error"}, order_by="ts")


@bound("invoice_min_risk", """
SELECT * FROM events WHERE user_id = 8 AND value >= 10
""")
def invoice_min_risk(spark, d):
    ev = table(spark, d, "events")
    return LK.find_where(ev, (F.col("user_id") == 8) & (F.col("value") >= 10), F.desc("value"))


@bound("param_sql", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'
""")
def param_sql(spark, d):
    return LK.param_sql(
        spark,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} "
        "WHERE o_orderdate >= CAST(:start AS TIMESTAMP_NTZ) AND o_orderstatus = :status",
        args={"start": "1998-01-01", "status": "F"},
        orders=table(spark, d, "orders"))


@bound("delete_where", """
SELECT * FROM orders
WHERE NOT COALESCE(o_orderstatus = 'P' OR CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice < 50000 END, FALSE)
""")
def delete_where(spark, d):
    o = table(spark, d, "orders")
    pred = (F.col("o_orderstatus") == "P") | F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice") < 50000)
    return FL.delete_where(o, pred)


@bound("union_years", """
SELECT o_orderkey, o_orderdate, o_totalprice, NULL::VARCHAR AS o_orderpriority FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_orderdate, NULL::DOUBLE, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def union_years(spark, d):
    # two yearly extracts with different column sets, united by name
    o = table(spark, d, "orders")
    early = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_orderdate", "o_totalprice")
    late = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_orderdate", "o_orderpriority")
    return LK.union_all(early, late)
