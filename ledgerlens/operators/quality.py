"""Header/detail reconciliation: orphans, detail totals, balance status.

All years are processed in one job; the per-year loop of a table-per-year
layout is replaced by the ``invoice_year`` column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.dedup import mark_uuid_duplicates
from ledgerlens.operators.joins import as_list, join_per_key
from ledgerlens.schemas import (
    BALANCED, DEFAULT_TOLERANCE, DETAIL_MISSING, DUPLICATE_KEY, HEADER_MISSING, MONEY, UNBALANCED,
    UNCHECKED, WITHIN_TOLERANCE,
)


def detail_total_per_header(detail: DataFrame, key, amount: str,
                            out: str = "detail_total_amount", dtype=MONEY) -> DataFrame:
    """Sum of ``amount`` per key over all detail rows (flagged ones too).

    A group whose amounts are all null sums to 0. The partial aggregate runs
    map-side, so a hot key costs one row per map task in the shuffle.
    """
    return (detail.groupBy(*as_list(key))
            .agg(F.coalesce(F.sum(F.col(amount).cast(dtype)), F.lit(0)).alias(out)))


#: keys without a partner that are broadcast
FEW_KEYS = 1 << 20


def _clean_keys(df: DataFrame, clean: str, columns, names) -> DataFrame:
    return df.filter(F.col(clean).isNull()).select(*[F.col(a).alias(b) for a, b in zip(columns, names)]).distinct()


def flag_orphans(left: DataFrame, right: DataFrame, key, label: str,
                 clean: str = "clean_status", right_key=None, updated_at=None,
                 updated_by=None, missing: DataFrame | None = None) -> DataFrame:
    """Mark clean ``left`` rows whose key is absent from clean ``right`` rows.

    Only rows with null ``clean`` take part on either side; already flagged
    rows keep their flag. The right side is reduced to its distinct keys
    (an aggregate, skew-safe), and AQE can split the rows of a hot key of ``left``.
    ``missing`` may give the distinct keys of ``left`` that ``right`` lacks, when
    they are few: they are broadcast, and no row of ``left`` is shuffled.
    """
    keys = as_list(key)
    rkeys = as_list(right_key) or keys
    if missing is not None:
        out = left.join(F.broadcast(missing.select(*keys).withColumn("__missing", F.lit(True))), keys, "left")
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        out = out.select(*left.columns, F.when(F.col("__missing").isNull() & ~null_key, F.lit(True)).alias("__present"))
    else:
        out = join_per_key(left, _clean_keys(right, clean, rkeys, keys).withColumn("__present", F.lit(True)), keys, "left")
    hit = F.col(clean).isNull() & F.col("__present").isNull()
    out = out.withColumn(clean, F.when(hit, F.lit(label)).otherwise(F.col(clean)))
    if updated_at is not None:
        out = out.withColumn("updated_at", F.when(hit, F.lit(updated_at).cast("timestamp_ntz"))
                             .otherwise(F.col("updated_at")))
    if updated_by is not None:
        out = out.withColumn("updated_by", F.when(hit, F.lit(updated_by)).otherwise(F.col("updated_by")))
    return out.drop("__present")


def orphans(left: DataFrame, right: DataFrame, key, right_key=None) -> DataFrame:
    """Rows of ``left`` whose key has no row in ``right`` (anti join)."""
    keys = as_list(key)
    rkeys = as_list(right_key) or keys
    r = right.select(*[F.col(a).alias(b) for a, b in zip(rkeys, keys)])
    return left.join(r, keys, "left_anti")


def balance_check(header: DataFrame, detail: DataFrame | None, key, total: str = "jshj",
                  detail_amount: str = "jshj", detail_totals: DataFrame | None = None,
                  tolerance: str = "balance_tolerance", default_tolerance: str = DEFAULT_TOLERANCE,
                  status: str = "is_balanced", clean: str = "clean_status",
                  checked_at=None, checked_by: str | None = None) -> DataFrame:
    """Attach detail totals and decide the balance status of each header.

    Eligible rows (clean status null and status '未校验') get
    ``balance_diff = |detail_total - total|`` and status '平账' (diff 0),
    '差异可接受' (diff <= tolerance, null tolerance = default) or '不平账'.
    A header without detail lines has a null total and stays unchecked.
    With ``detail`` and ``detail_totals`` both None the header must already
    carry ``detail_total_amount``.
    Manual states such as '强制通过' are never touched. Check time/by are
    written only where the status changed. Arithmetic is DECIMAL.
    """
    keys = as_list(key)
    h = header
    if detail is None and detail_totals is None:
        # totals already attached by the caller (one join, no second aggregate)
        if "detail_total_amount" not in h.columns:
            raise ValueError("need detail, detail_totals or a detail_total_amount column")
    else:
        totals = detail_totals if detail_totals is not None else \
            detail_total_per_header(detail, keys, detail_amount)
        if "detail_total_amount" in h.columns:
            h = h.drop("detail_total_amount")
        h = h.join(totals, keys, "left")
    for c, t in (("balance_diff", MONEY), ("balance_check_time", T.TimestampNTZType()),
                 ("balance_check_by", T.StringType())):
        if c not in h.columns:
            h = h.withColumn(c, F.lit(None).cast(t))
    tol = F.coalesce(F.col(tolerance).cast(MONEY), F.lit(default_tolerance).cast(MONEY)) \
        if tolerance in h.columns else F.lit(default_tolerance).cast(MONEY)
    diff = F.abs(F.col("detail_total_amount") - F.col(total).cast(MONEY))
    eligible = F.col(clean).isNull() & (F.col(status) == UNCHECKED) if clean in h.columns \
        else (F.col(status) == UNCHECKED)
    eligible = F.coalesce(eligible, F.lit(False))
    new_status = (F.when(eligible & (diff == 0), BALANCED)
                  .when(eligible & (diff > 0) & (diff <= tol), WITHIN_TOLERANCE)
                  .when(eligible & (diff > tol), UNBALANCED)
                  .otherwise(F.col(status)))
    changed = eligible & ~new_status.eqNullSafe(F.col(status))
    h = h.withColumns({
        "balance_diff": F.when(eligible, diff).otherwise(F.col("balance_diff")),
        "balance_check_time": F.when(changed, F.lit(checked_at).cast("timestamp_ntz"))
        .otherwise(F.col("balance_check_time")) if checked_at is not None else F.col("balance_check_time"),
        "balance_check_by": F.when(changed, F.lit(checked_by)).otherwise(F.col("balance_check_by"))
        if checked_by is not None else F.col("balance_check_by"),
    })
    return h.withColumn(status, new_status)


#: where an imported row stood: decides among rows of one time stamp
PLACE = ("source_file", "source_sheet", "row_no")


def _with_place(df: DataFrame, order) -> list[str]:
    return [*order, *[c for c in PLACE if c in df.columns and c not in order]]


def run_dq(header: DataFrame, detail: DataFrame, header_key="header_uuid",
           detail_key="detail_uuid", link_key="header_uuid", header_order=("created_at",),
           detail_order=("updated_at",), total: str = "jshj", detail_amount: str = "jshj",
           checked_at=None, checked_by: str | None = None, stage=None):
    """The whole quality pass: key uniqueness, orphans, totals, balance.

    Returns ``(header', detail')``. Flags are sticky: a row already carrying
    a clean status keeps it. Orphan checks use only rows still clean after
    the uniqueness step; detail totals include every detail row. ``stage``
    (frame, name -> frame) may store the flagged headers and lines, so that
    neither is flagged once more for the other's sake; ``header`` and
    ``detail`` are stored tables then.
    """
    stage, stored = stage or (lambda df, name: df), stage is not None
    h_stamp = dict(updated_at=checked_at if "updated_at" in header.columns else None,
                   updated_by=checked_by if "updated_by" in header.columns else None)
    d_stamp = dict(updated_at=checked_at if "updated_at" in detail.columns else None,
                   updated_by=checked_by if "updated_by" in detail.columns else None)
    h = stage(mark_uuid_duplicates(header, header_key, _with_place(header, header_order), DUPLICATE_KEY, stored=stored, **h_stamp),
              "dq-header-keys")
    d = mark_uuid_duplicates(detail, detail_key, _with_place(detail, detail_order), DUPLICATE_KEY, stored=stored, **d_stamp)
    # both checks read the state after the uniqueness step
    missing = None
    if stored:
        link = as_list(link_key)
        missing = stage(detail.select(*link).distinct().join(_clean_keys(h, "clean_status", as_list(header_key), link), link, "left_anti"),
                        "dq-missing")
        missing = missing if missing.count() <= FEW_KEYS else None
    d2 = stage(flag_orphans(d, h, link_key, HEADER_MISSING, right_key=header_key, missing=missing, **d_stamp), "dq-detail")
    # one aggregate of the lines serves the headers: their total, and whether a clean line is there. Lines
    # that are flagged as orphans have no clean header, and a header that is flagged takes no part
    lines = d2.groupBy(*as_list(link_key)).agg(
        F.coalesce(F.sum(F.col(detail_amount).cast(MONEY)), F.lit(0)).alias("detail_total_amount"),
        F.bool_or(F.col("clean_status").isNull()).alias("__has_line"))
    lines = lines.select(*[F.col(a).alias(b) for a, b in zip(as_list(link_key), as_list(header_key))],
                         "detail_total_amount", "__has_line")
    h2 = join_per_key(h.drop("detail_total_amount"), lines, as_list(header_key), "left")
    alone = F.col("clean_status").isNull() & ~F.coalesce("__has_line", F.lit(False))
    stamps = {c: F.lit(v).cast(h2.schema[c].dataType) for c, v in h_stamp.items() if v is not None}
    h2 = h2.withColumns({c: F.when(alone, v).otherwise(F.col(c)) for c, v in stamps.items()})
    h2 = h2.withColumn("clean_status", F.when(alone, F.lit(DETAIL_MISSING)).otherwise(F.col("clean_status")))
    h3 = balance_check(h2.drop("__has_line"), None, header_key, total=total, checked_at=checked_at,
                       checked_by=checked_by)
    return h3, d2


def issue_counts(header: DataFrame, detail: DataFrame, clean: str = "clean_status",
                 status: str = "is_balanced") -> DataFrame:
    """Counts per (table, field, value) of the quality flags: one pass per
    table (both header fields are unpivoted and counted together)."""
    def counted(df: DataFrame, table_name: str, fields: list[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("")).alias("value"))
                          for f in fields])
        return (df.select(F.explode(pairs).alias("__p"))
                .groupBy(F.lit(table_name).alias("table_name"), F.col("__p.field").alias("field"),
                         F.col("__p.value").alias("value"))
                .agg(F.count(F.lit(1)).alias("rows")))
    return counted(header, "header", [clean, status]).unionByName(counted(detail, "detail", [clean]))
