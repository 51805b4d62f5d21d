"""Projection and schema alignment: rename maps, fixed column lists,
blank rows, column-name cleanup, re-ordering, audit and default columns.

All of these are metadata operations (``select`` lists built on the
driver from the schema) plus per-row column expressions.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.parse import is_blank


def align_schema(df: DataFrame, mapping: dict[str, str], columns: list[str],
                 types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Rename by ``mapping`` (source -> target), add missing target columns as
    typed nulls, project to ``columns`` in that order. When two source
    columns map to one target the later one wins."""
    types = types or {}
    src_for = {}
    for c in df.columns:
        src_for[mapping.get(c, c)] = c
    out = []
    for c in columns:
        t = types.get(c, T.StringType())
        if c in src_for:
            out.append(F.col(f"`{src_for[c]}`").alias(c) if c not in types else
                       F.col(f"`{src_for[c]}`").cast(t).alias(c))
        else:
            out.append(F.lit(None).cast(t).alias(c))
    return df.select(*out)


def drop_blank_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows whose every cell (of ``columns``) is null or blank."""
    cols = columns or df.columns
    any_value = reduce(lambda a, b: a | b, [~is_blank(f"`{c}`") for c in cols])
    return df.filter(any_value)


_NAME_SPACES = re.compile(r"[ 　]")


def clean_name(name: str) -> str:
    """Trim and remove ASCII and full-width spaces from a column title."""
    return _NAME_SPACES.sub("", name.strip())


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename columns to their cleaned titles; when two names clash the last
    one is kept."""
    cleaned = [clean_name(c) for c in df.columns]
    keep = {}
    for i, c in enumerate(cleaned):
        keep[c] = i
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(c) for c, i in sorted(keep.items(), key=lambda x: x[1])])


def reorder_columns(df: DataFrame, standard: list[str], technical: list[str] | None = None) -> DataFrame:
    """Technical columns (only those present) first, then the standard
    order, then every other column in its current order."""
    lead = [c for c in (technical or []) if c in df.columns] + [c for c in standard if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    return df.select(*[F.col(f"`{c}`") for c in lead + rest])


def schema_union(frames: list[DataFrame], sort_columns: bool = True) -> DataFrame:
    """Union by name across frames with different columns (missing -> null),
    columns in sorted order for a stable schema."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.select(*sorted(out.columns)) if sort_columns else out


def audit_columns(df: DataFrame, import_ts: str, source_col: str = "source_file") -> DataFrame:
    """Add the source file name (from the scan's file metadata) and the batch
    import time."""
    return df.withColumns({source_col: F.col("_metadata.file_name"),
                           "import_ts": F.lit(import_ts).cast("timestamp_ntz")})


def default_fill(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """``coalesce(col, default)`` for present columns; absent ones are added."""
    cols = {}
    for c, v in defaults.items():
        lit = F.lit(v)
        cols[c] = F.coalesce(F.col(c), lit.cast(df.schema[c].dataType)) if c in df.columns else lit
    return df.withColumns(cols)


def invoice_struct(df: DataFrame, fields: dict[str, str], rate_num: str, rate_text: str,
                   out: str = "record") -> DataFrame:
    """A fixed record struct; the rate falls back from the numeric rate to
    the text rate cast to a number."""
    rate = F.coalesce(F.col(rate_num).cast("double"), F.col(rate_text).try_cast("double"))
    return df.withColumn(out, F.struct(*[F.col(src).alias(dst) for dst, src in fields.items()],
                                       rate.alias("tax_rate")))
