"""The driver contract: entry, queries and oracle SQL agree."""

import duckdb

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlens.plans.tables import TABLES


def test_oracle_keys_are_queries():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def test_oracle_sql_parses(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    for name, sql in oracle_sql().items():
        con.sql(f"SELECT * FROM ({sql}) LIMIT 0").columns


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["o_orderkey", "jshj", "detail_total_amount", "balance_diff", "is_balanced",
                          "balance_check_by"]


def test_sample_of_queries_match_oracle(spark, sf_small):
    """A fast subset at sf0.001; tools/oracle_check.py runs all keys."""
    import sys
    import os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from oracle_check import rows_of_duck, rows_of_spark
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    q, o = queries(), oracle_sql()
    for name in ["balance_check", "dq_header", "dedup_detail_ledger", "quarantine_all_copies", "parse_invoice_date",
                 "header_uuid", "cast_stats", "invoice_number_gaps", "similar_seller_names", "overwrite_years"]:
        assert rows_of_spark(q[name](spark, sf_small)) == rows_of_duck(con.sql(o[name])), name
