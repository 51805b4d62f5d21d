"""Reading the shared test tables and shaping them into invoice roles.

The driver tables are a star schema; the invoice concepts bind to them as
follows (same derivations are written in SQL in each ``plans/bind_*.py``):

* header = ``orders``   (invoice key ``o_orderkey``, buyer ``o_custkey``,
  date ``o_orderdate``, status ``o_orderstatus``)
* detail = ``lineitem`` (invoice key ``l_orderkey``, line ``l_linenumber``,
  seller ``l_suppkey``, rate = ``l_tax * 100`` as DECIMAL(9,2))
* seller / buyer dimensions = ``supplier`` / ``customer``
* error log = ``events``; free text = ``documents``

Reads name only the columns a query needs, so the parquet scan prunes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def money(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def line_order(prefix: str = "l_") -> list[str]:
    """A total order over lineitem rows (all columns after the key)."""
    return [f"{prefix}shipdate", f"{prefix}partkey", f"{prefix}suppkey", f"{prefix}quantity",
            f"{prefix}extendedprice", f"{prefix}discount", f"{prefix}tax", f"{prefix}returnflag",
            f"{prefix}linestatus"]


LINE_ORDER_SQL = ("l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
                  "l_tax, l_returnflag, l_linestatus")
