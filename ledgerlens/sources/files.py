"""File listing and admission through Spark's ``binaryFile`` source.

Only metadata columns are selected, so file contents are never read for
listing (the source prunes the ``content`` column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.sheets import file_admission


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, name, length, modificationTime) of every file under ``path``."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path).select("path", "length", "modificationTime")
    return df.withColumn("name", F.element_at(F.split("path", "/"), -1))


def admitted_files(spark: SparkSession, path: str, max_mb: float = 500.0) -> DataFrame:
    """Every listed file with ``accepted`` and ``reason`` (both sides kept)."""
    return file_admission(list_files(spark, path), "name", "length", max_mb)
