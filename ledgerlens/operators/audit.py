"""Cast-and-record and other audit side outputs.

``cast_and_record`` parses named raw columns and produces, in one pass
each, the typed frame, per-(file, sheet, column, method) statistics and
one row per value that failed to parse. Error logs are enriched with a
remedy text and a category; statistics use GROUPING SETS.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.errors import error_category, error_suggestion
from ledgerlens.functions.parse import is_blank, is_tax_free_token, parse_invoice_date, parse_numeric, parse_tax_rate, strip
from ledgerlens.operators.joins import as_list

DATE, NUMERIC, TAX_RATE = "date", "numeric", "tax_rate"
RATE_NUM_SUFFIX = "_数值"


def _parsed(c: str, kind: str, text_to_zero: bool):
    if kind == DATE:
        return parse_invoice_date(c)
    if kind == TAX_RATE:
        return parse_tax_rate(c, text_to_zero)
    return parse_numeric(c)


def typed_frame(df: DataFrame, specs: dict[str, str], text_to_zero: bool = True) -> DataFrame:
    """Replace each spec column by its parsed value; a tax-rate column keeps
    its text and gains ``<col>_数值`` (numeric)."""
    cols = {}
    for c, kind in specs.items():
        if kind == TAX_RATE:
            cols[c + RATE_NUM_SUFFIX] = _parsed(c, kind, text_to_zero)
        else:
            cols[c] = _parsed(c, kind, text_to_zero)
    return df.withColumns(cols)


def cast_failures(df: DataFrame, specs: dict[str, str], by=("file", "sheet"), row: str = "row_index",
                  keys=()) -> DataFrame:
    """One row per non-blank raw value that did not parse:
    (by..., column, row, orig_value, keys...).

    One filter per spec column, united: each branch reads only the keys and
    its own column and parses it once (2.6x faster than exploding an array
    of conditional structs, measured on 600k rows). A filter evaluates every
    reference to a column's expression anew, so only values that did not
    parse are asked whether they are blank.
    """
    parts = []
    for c, kind in specs.items():
        parsed = parse_tax_rate(c, text_to_zero=True) if kind == TAX_RATE else _parsed(c, kind, True)
        parts.append(df.filter(parsed.isNull() & (strip(F.col(c)) != ""))
                     .select(*as_list(by), F.lit(c).alias("column"), F.col(row),
                             F.col(c).cast("string").alias("orig_value"), *as_list(keys)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def cast_stats(df: DataFrame, specs: dict[str, str], by=("file", "sheet"), text_to_zero: bool = True) -> DataFrame:
    """(by..., column, method, total, converted, failed) for every spec column.

    date/numeric: converted = parsed non-null, failed = total - converted.
    tax rate: '<col>_数值'/'tax_parse' (numeric parses; failed = neither
    numeric, token nor blank), plus, when tax-free tokens occur,
    '<col>_数值'/'map_tax_text_to_zero' and '<col>'/'tax_text_tokens'.

    One small aggregation per column, united: each reads the group columns
    and its own column and parses it once (narrow generated code stays
    JIT-compiled; faster than one wide aggregation over all columns).
    """
    by = as_list(by)
    parts = []
    for c, kind in specs.items():
        total = F.count(F.lit(1))
        if kind == TAX_RATE:
            flags = df.select(*by, parse_tax_rate(c, text_to_zero=False).isNotNull().alias("__c"),
                              is_tax_free_token(c).alias("__t"), is_blank(c).alias("__b"))
            g = flags.groupBy(*by).agg(total.alias("total"), F.count_if("__c").alias("conv"),
                                       F.count_if(~F.col("__c") & ~F.col("__t") & ~F.col("__b")).alias("fail"),
                                       F.count_if("__t").alias("tok"))
            t, conv, tok = F.col("total"), F.col("conv"), F.col("tok")
            rows = [F.struct(F.lit(c + RATE_NUM_SUFFIX).alias("column"), F.lit("tax_parse").alias("method"),
                             t.alias("total"), conv.alias("converted"), F.col("fail").alias("failed"))]
            if text_to_zero:
                rows.append(F.when(tok > 0, F.struct(
                    F.lit(c + RATE_NUM_SUFFIX).alias("column"), F.lit("map_tax_text_to_zero").alias("method"),
                    t.alias("total"), tok.alias("converted"), F.lit(0).cast("bigint").alias("failed"))))
            rows.append(F.when(tok > 0, F.struct(
                F.lit(c).alias("column"), F.lit("tax_text_tokens").alias("method"),
                t.alias("total"), tok.alias("converted"), (t - tok - conv).alias("failed"))))
            # one small row per group is exploded into its statistics rows
            parts.append(g.select(*by, F.explode(F.array_compact(F.array(*rows))).alias("__s"))
                         .select(*by, "__s.*"))
        else:
            method = "date_parse" if kind == DATE else "numeric_parse"
            flags = df.select(*by, _parsed(c, kind, text_to_zero).isNotNull().alias("__c"))
            g = flags.groupBy(*by).agg(total.alias("total"), F.count_if("__c").alias("converted"))
            parts.append(g.select(*by, F.lit(c).alias("column"), F.lit(method).alias("method"), "total",
                                  "converted", (F.col("total") - F.col("converted")).alias("failed")))
    return reduce(lambda a, b: a.unionByName(b), parts)


PARSED = "__parsed_"


def parse_once(df: DataFrame, specs: dict[str, str], text_to_zero: bool = True) -> DataFrame:
    """``df`` with a parsed column beside each spec column. Written to a stage
    table, it serves the typed frame, the statistics and the failures, which
    then parse nothing again (``typed_from``, ``stats_from``, ``failures_from``)."""
    return df.withColumns({PARSED + c: _parsed(c, kind, text_to_zero) for c, kind in specs.items()})


def typed_from(parsed: DataFrame, specs: dict[str, str]) -> DataFrame:
    """``typed_frame`` of the rows that ``parse_once`` prepared."""
    rates = [c for c, kind in specs.items() if kind == TAX_RATE]
    cols = {c: F.col(PARSED + c) for c in specs if c not in rates} | {c + RATE_NUM_SUFFIX: F.col(PARSED + c) for c in rates}
    return parsed.withColumns(cols).drop(*[PARSED + c for c in specs])


def failures_from(parsed: DataFrame, specs: dict[str, str], by=("file", "sheet"), row: str = "row_index",
                  keys=()) -> DataFrame:
    """``cast_failures`` of the rows that ``parse_once`` prepared: one scan,
    whose rows without a failure are filtered before the failures unfold.
    Needs ``text_to_zero`` (a token that counts as zero is no failure)."""
    failed = {c: ~is_blank(c) & F.col(PARSED + c).isNull() for c in specs}
    found = F.array_compact(F.array(*[F.when(f, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("orig_value")))
                                      for c, f in failed.items()]))
    return (parsed.filter(reduce(lambda a, b: a | b, failed.values()))
            .select(*as_list(by), F.col(row), *as_list(keys), F.explode(found).alias("__f"))
            .select(*as_list(by), "__f.column", row, "__f.orig_value", *as_list(keys)))


def stats_from(parsed: DataFrame, specs: dict[str, str], by=("file", "sheet")) -> DataFrame:
    """``cast_stats`` (with ``text_to_zero``) of the rows that ``parse_once``
    prepared: one aggregation for all columns, unfolded per group."""
    by = as_list(by)
    sums, rows = [F.count(F.lit(1)).alias("__n")], []

    def row(column, method, converted, failed):
        return F.struct(F.lit(column).alias("column"), F.lit(method).alias("method"), F.col("__n").alias("total"),
                        converted.alias("converted"), failed.alias("failed"))

    for i, (c, kind) in enumerate(specs.items()):
        there, conv = F.col(PARSED + c).isNotNull(), F.col(f"__c{i}")
        if kind == TAX_RATE:
            token = is_tax_free_token(c)
            sums += [F.count_if(there & ~token).alias(f"__c{i}"), F.count_if(token).alias(f"__t{i}"),
                     F.count_if(~there & ~token & ~is_blank(c)).alias(f"__f{i}")]
            tok = F.col(f"__t{i}")
            rows += [row(c + RATE_NUM_SUFFIX, "tax_parse", conv, F.col(f"__f{i}")),
                     F.when(tok > 0, row(c + RATE_NUM_SUFFIX, "map_tax_text_to_zero", tok, F.lit(0).cast("bigint"))),
                     F.when(tok > 0, row(c, "tax_text_tokens", tok, F.col("__n") - tok - conv))]
        else:
            sums.append(F.count_if(there).alias(f"__c{i}"))
            rows.append(row(c, "date_parse" if kind == DATE else "numeric_parse", conv, F.col("__n") - conv))
    return (parsed.groupBy(*by).agg(*sums).select(*by, F.explode(F.array_compact(F.array(*rows))).alias("__s"))
            .select(*by, "__s.*"))


def cast_and_record(df: DataFrame, specs: dict[str, str], by=("file", "sheet"), row: str = "row_index",
                    keys=(), text_to_zero: bool = True):
    """(typed, stats, failures) for the spec columns of a sheet frame."""
    return (typed_frame(df, specs, text_to_zero), cast_stats(df, specs, by, text_to_zero),
            cast_failures(df, specs, by, row, keys))


def enrich_errors(df: DataFrame, error_type: str = "error_type", message: str = "message") -> DataFrame:
    """Add ``suggestion`` (kept when already filled) and ``category``."""
    sug = error_suggestion(error_type, message)
    if "suggestion" in df.columns:
        sug = F.when(is_blank("suggestion"), sug).otherwise(F.col("suggestion"))
    return df.withColumns({"suggestion": sug, "category": error_category(error_type, message)})


def error_stats(df: DataFrame, category: str = "category", level: str = "level") -> DataFrame:
    """Error counts in total, per category and per level (GROUPING SETS).

    ``grouping_id`` tells the sets apart: 3 = total, 1 = per category,
    2 = per level.
    """
    c, lv = F.col(category), F.col(level)
    return (df.groupingSets([[], [c], [lv]], c, lv)
            .agg(F.count(F.lit(1)).alias("error_count"), F.grouping_id().alias("grouping_id")))


def import_summary(files: DataFrame, status: str = "status") -> DataFrame:
    """One row of file counts: total, processed, scan-failed, read-failed.

    The failed names themselves are rows of ``failed_files`` (not one
    concatenated string, which would be unbounded)."""
    s = F.col(status)
    return files.agg(F.count(F.lit(1)).alias("total_files"),
                     F.count_if(s == "processed").alias("processed_files"),
                     F.count_if(s == "scan_failed").alias("scan_failed_files"),
                     F.count_if(s == "read_failed").alias("read_failed_files"))


def failed_files(files: DataFrame, name: str = "file", status: str = "status") -> DataFrame:
    return files.filter(F.col(status).isin("scan_failed", "read_failed")).select(name, status)
