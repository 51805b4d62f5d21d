"""Duplicate handling: keep-first flags, quarantine, line numbers, metrics.

"First" is defined by explicit order columns (arrival order: source file,
sheet, row number, or any total order the caller gives); Spark rows have
no inherent order.

Skew: a group of copies may hold a large share of all rows, so no window
is partitioned by the key alone. Group flags (``group_flags``) take two
levels for every key alike: rows are first compared within (key, salt), the
salt being a hash of the row, and only the first row of each salt, at most
``SALTS`` a key, is compared within the key. Of a stored table, whose keys can
be counted beforehand, only rows of hot keys need the first level. Line numbers work the same way
over ranges of the order (``logic_line_no``).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.joins import as_list, join_per_key
from ledgerlens.session import scratch_path

_REPEATED = "__repeated"
_IS_FIRST = "__is_first"

#: parts into which the rows of one key are split; the second level sees one row of each
SALTS = 1 << 14


def _row_hash(df: DataFrame) -> F.Column:
    """A hash of the whole row (maps, which Spark cannot hash, left out)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


#: rows from which a key of a stored frame is split
HOT_ROWS = 100_000


def group_flags(df: DataFrame, keys, order=None, keep: str = "first", stored: bool = False) -> DataFrame:
    """``df`` plus ``__repeated`` (other rows share the key; null keys form
    one group) and ``__is_first`` (the first row of its group by ``order``,
    or the last with ``keep='last'``; of rows equal in ``order``, or without
    an order, exactly one).

    Rows meet within (key, salt) first. Later rows of a salt are settled
    there; the first ones, at most ``SALTS`` a key, meet again within the key.
    A key with any share of the rows is thus spread over ``SALTS`` groups at
    both levels (rows equal in all columns fall into one).

    ``stored``: ``df`` is a stored table, cheap to read again. Its keys are
    counted first, by a hash of the key columns, and only rows of hashes with
    ``HOT_ROWS`` rows take two levels; the others are shuffled once. Either
    way settles a row rightly, so hashes that meet do no harm. A table of
    fewer rows has no such hash.

    Groups are sorted by a hash of their keys first: long texts are compared
    within a hash alone.
    """
    keys = as_list(keys)
    sort = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in as_list(order)] or [F.lit(0)]
    hashed = df.withColumn("__hash", F.xxhash64(*keys))
    rows, cold = hashed, None
    if stored and df.count() < HOT_ROWS:
        rows, cold = None, hashed
    elif stored:
        hot = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= HOT_ROWS)
        marked = hashed.join(F.broadcast(hot.select("__hash", F.lit(True).alias("__hot"))), "__hash", "left")
        rows = marked.filter("__hot").select(*df.columns, "__hash")
        cold = marked.filter("__hot is null").select(*df.columns, "__hash")
    local = None
    if rows is not None:
        salted = rows.withColumn("__salt", F.pmod(_row_hash(df), F.lit(SALTS)))
        w = Window.partitionBy("__hash", *keys, "__salt").orderBy(*sort)
        local = salted.withColumns({"__nth": F.row_number().over(w), "__more": F.lead(F.lit(True), 1, False).over(w)})
    if cold is not None:
        cold = cold.withColumns({"__salt": F.lit(0).cast("long"), "__nth": F.lit(1), "__more": F.lit(False)})
        local = cold if local is None else local.unionByName(cold)
    # the first rows of all salts meet under -1, the others stay under their salt
    local = local.withColumn("__level", F.when(F.col("__nth") == 1, F.lit(-1)).otherwise(F.col("__salt")))
    w = Window.partitionBy("__hash", *keys, "__level").orderBy(*sort)
    whole = Window.partitionBy("__hash", *keys, "__level")
    alone = (F.count(F.lit(1)).over(whole) == 1) & ~F.max("__more").over(whole)
    return local.withColumns({
        _REPEATED: (F.col("__nth") > 1) | ~alone,
        _IS_FIRST: (F.col("__nth") == 1) & (F.row_number().over(w) == 1),
    }).select(*df.columns, _REPEATED, _IS_FIRST)


def _keys_present(keys) -> F.Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in as_list(keys)])


def flag_duplicates(df: DataFrame, keys, order, keep: str = "first",
                    flag: str = "is_duplicate", null_safe: bool = True, stored: bool = False) -> DataFrame:
    """Add boolean ``flag``: True for every row but the first (or last) per key.

    Nulls in key columns compare equal (``null_safe``), like pandas
    ``duplicated``; with ``null_safe=False`` a row with a null key is never a
    duplicate. ``order`` must be a total order within a key group. ``stored``
    as in ``group_flags``.
    """
    keys = as_list(keys)
    out = group_flags(df, keys, order, keep, stored)
    dup = ~F.col(_IS_FIRST)
    if not null_safe:
        dup = _keys_present(keys) & dup
    return out.withColumn(flag, dup).drop(_IS_FIRST, _REPEATED)


def keep_first(df: DataFrame, keys, order, keep: str = "first", null_safe: bool = True) -> DataFrame:
    return (flag_duplicates(df, keys, order, keep, "__dup", null_safe)
            .filter(~F.col("__dup")).drop("__dup"))


def build_ledger(df: DataFrame, keys, order, columns=None, keep: str = "first",
                 captured_at=None, null_safe: bool = True):
    """Split a frame into (ledger, duplicates) by keep-first on ``keys``.

    ``columns`` projects both outputs (only those present); duplicates carry
    ``dedup_captured_at`` when ``captured_at`` is given.
    """
    flagged = flag_duplicates(df, keys, order, keep, "__dup", null_safe)
    cols = [c for c in (columns or df.columns) if c in df.columns]
    ledger = flagged.filter(~F.col("__dup")).select(*cols)
    dups = flagged.filter(F.col("__dup")).select(*cols)
    if captured_at is not None:
        dups = dups.withColumn("dedup_captured_at", F.lit(captured_at).cast("timestamp_ntz"))
    return ledger, dups


def dedup_metrics(flagged: DataFrame, year: str, flag: str = "is_duplicate",
                  kind: str | None = None) -> DataFrame:
    """Per year: rows_before, rows_after, rows_dropped, in one aggregation pass."""
    out = flagged.groupBy(year).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~F.col(flag)).alias("rows_after"),
        F.count_if(F.col(flag)).alias("rows_dropped"))
    if kind is not None:
        out = out.withColumn("type", F.lit(kind))
    return out


def mark_uuid_duplicates(df: DataFrame, key, order, label: str, clean: str = "clean_status",
                         updated_at=None, updated_by=None, stored: bool = False) -> DataFrame:
    """Earliest row per key stays as is; later copies get ``clean = label``.

    Rows with a null key are never marked (pandas groupby drops null keys).
    ``updated_at`` / ``updated_by`` are stamped on marked rows when given.
    """
    keys = as_list(key)
    out = group_flags(df, keys, order, "first", stored)
    # rows with a null key are never marked (pandas groupby drops null keys)
    hit = _keys_present(keys) & ~F.col(_IS_FIRST)
    out = out.withColumn(clean, F.when(hit, F.lit(label)).otherwise(F.col(clean)))
    if updated_at is not None:
        out = out.withColumn("updated_at", F.when(hit, F.lit(updated_at).cast("timestamp_ntz"))
                             .otherwise(F.col("updated_at")))
    if updated_by is not None:
        out = out.withColumn("updated_by", F.when(hit, F.lit(updated_by)).otherwise(F.col("updated_by")))
    return out.drop(_IS_FIRST, _REPEATED)


def repeated_keys(df: DataFrame, key, by=(), min_count: int = 2) -> DataFrame:
    """Keys occurring at least ``min_count`` times (optionally per ``by``)."""
    cols = as_list(by) + as_list(key)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") >= min_count))


def quarantine(df: DataFrame, key, known_keys: DataFrame | None = None, known_key=None,
               mode: str = "reject_all", order=None, reason: str = "quarantine_reason", reduced: bool = False,
               repeats: DataFrame | None = None, stored: bool = False):
    """Split an import batch into (accepted, quarantined) by ``quarantine_reasons``;
    the quarantined rows carry the reason."""
    out = quarantine_reasons(df, key, known_keys, known_key, mode, order, reason, reduced, repeats, stored)
    return out.filter(F.col(reason).isNull()).drop(reason), out.filter(F.col(reason).isNotNull())


def quarantine_reasons(df: DataFrame, key, known_keys: DataFrame | None = None, known_key=None,
                       mode: str = "reject_all", order=None, reason: str = "quarantine_reason", reduced: bool = False,
                       repeats: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """An import batch with the reason why a row is quarantined (null: accepted).

    Quarantined: every copy of a key repeated inside the batch
    (``mode='reject_all'``; ``'keep_first'`` admits the first copy), and every
    row whose key is already known (``known_keys``; ``reduced`` when these are
    distinct keys of the batch, as a key index gives them). Accepted +
    quarantined = input, always. With 'reject_all', ``repeats`` may give the
    distinct non-null keys that the batch holds several times: no rows are
    grouped then, and when Spark can broadcast these keys none are shuffled.
    ``stored`` as in ``group_flags``.
    """
    keys = as_list(key)
    if mode == "reject_all" and repeats is not None:
        out = join_per_key(df, repeats.select(*keys).withColumn(_REPEATED, F.lit(True)), keys, "left")
        repeated = F.col(_REPEATED).isNotNull()
    else:
        out = group_flags(df, keys, order if mode == "keep_first" else None, "first", stored)
        repeated = _keys_present(keys) & F.col(_REPEATED)
        if mode == "keep_first":
            repeated = repeated & ~F.col(_IS_FIRST)
    if known_keys is not None:
        kk = as_list(known_key) or keys
        marks = known_keys.select(*[F.col(a).alias(b) for a, b in zip(kk, keys)])
        if not reduced:
            # only the batch's keys matter: reduced by them before anything is shuffled
            # when the batch is small enough for Spark to broadcast its keys
            marks = marks.join(df.select(*keys).distinct(), keys, "left_semi").distinct()
        marks = marks.withColumn("__known", F.lit(True))
        out = join_per_key(out, marks, keys, "left")
        known = F.coalesce(F.col("__known"), F.lit(False))
    else:
        known = F.lit(False)
    out = out.withColumn(reason, F.when(known, "already_imported")
                         .when(repeated, "repeated_in_batch"))
    drop = [c for c in (_REPEATED, _IS_FIRST, "__known") if c in out.columns]
    return out.drop(*drop)


def logic_line_no(df: DataFrame, key, order, scope=("source_file", "source_sheet"),
                  out: str = "logic_line_no") -> DataFrame:
    """Line number 1, 2, ... of each row inside its invoice, in ``order``.

    ``scope`` restricts numbering to one file/sheet (a re-delivered file then
    reproduces the same numbers and collides on the detail key); a group is
    then bounded by one sheet (at most 1,048,576 rows in the xlsx format).
    Rows are sorted by a hash of scope and key first: files share long
    beginnings of their names, which a sort of names would compare.
    ``scope=()`` numbers across the whole batch, where one invoice may hold
    any share of the rows: ``numbered``.
    """
    part = [c for c in as_list(scope) if c in df.columns] + as_list(key)
    if not as_list(scope):
        return numbered(df, part, order, out)
    w = Window.partitionBy("__part", *part).orderBy(*[F.col(c) for c in as_list(order) if c not in part] or [F.lit(0)])
    return df.withColumn("__part", F.xxhash64(*part)).withColumn(out, F.row_number().over(w)).drop("__part")


def numbered(df: DataFrame, key, order, out: str) -> DataFrame:
    """``row_number`` within ``key`` for keys of any size, in two levels: rows
    are sorted over all tasks by key and order, numbered within (key, task),
    and the key's rows in earlier tasks are added, from one count per key and
    task. The sorted rows are written to the shared checkpoint folder, so
    both levels see the same tasks."""
    spark, key = df.sparkSession, as_list(key)
    sort = [F.col(c).asc() for c in [*key, *as_list(order)]]
    path = scratch_path(spark, f"numbered-{uuid.uuid4().hex[:12]}")
    (df.repartitionByRange(*sort).sortWithinPartitions(*sort)
     .withColumn("__at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("__task", F.shiftright("__at", 33))
    counts = rows.groupBy(*key, "__task").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(*key).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__ahead", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    names = [f"__k{i}" for i in range(len(key))]
    counts = counts.select(*[F.col(k).alias(n) for k, n in zip(key, names)], F.col("__task").alias("__t"), "__first", "__ahead")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)], F.col("__task") == F.col("__t"))
    number = F.col("__at") - F.col("__first") + 1 + F.col("__ahead")
    return rows.join(counts, same).select(*df.columns, number.cast("int").alias(out))


def top_n_per_group(df: DataFrame, by, order, n: int, rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per group. ``row_number() <= n`` lets Spark insert a
    partial per-partition limit before the shuffle (WindowGroupLimit), so a
    hot group ships at most ``n`` rows per map task."""
    w = Window.partitionBy(*as_list(by)).orderBy(*order) if not isinstance(order, str) \
        else Window.partitionBy(*as_list(by)).orderBy(order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
