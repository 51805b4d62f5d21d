"""ledgerlens: invoice-ledger auditing as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a tuple of
DataFrames for split operators) built from ``pyspark.sql.functions``.
Column names are parameters, so the same code runs on invoice tables and
on any table that plays the same role.
"""

__version__ = "0.1.0"
