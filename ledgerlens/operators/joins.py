"""Join helpers: key-set membership, joins to per-key rows, coverage.

Invoice keys are high-cardinality, so key-set joins are shuffle joins that
AQE may split when one key is hot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import STAGE_CODEC, path_exists, scratch_path, stored_bytes


def as_list(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def join_per_key(rows: DataFrame, per_key: DataFrame, keys, how: str = "inner") -> DataFrame:
    """``rows`` joined to per-key aggregates of any size. The aggregate is
    dealt by the keys already, and Spark would join it as it stands, so a hot
    key's rows could not be split; joining on the keys and a hash of them
    gives both sides an exchange of the join's own, which AQE splits."""
    keys = as_list(keys)
    out = rows.columns + [c for c in per_key.columns if c not in keys]
    mark = F.xxhash64(*keys)
    return (rows.withColumn("__key_hash", mark)
            .join(per_key.withColumn("__key_hash", mark), [*keys, "__key_hash"], how).select(*out))


def split_known_keys(df: DataFrame, known_keys: DataFrame, key, known_key=None, normalize: bool = False):
    """Split rows into (new, known) by membership of ``key`` in ``known_keys``.

    ``known_keys`` may hold duplicates; semi/anti joins need no distinct.
    ``normalize`` compares keys trimmed and lower-cased on both sides (the
    tolerant second check against a target table).
    """
    keys = as_list(key)
    kk = as_list(known_key) or keys
    if normalize:
        names = [f"__nk_{i}" for i in range(len(keys))]
        left = df.withColumns({n: normalized_key(k) for n, k in zip(names, keys)})
        right = known_keys.select(*[normalized_key(a).alias(n) for a, n in zip(kk, names)])
        return (left.join(right, names, "left_anti").drop(*names),
                left.join(right, names, "left_semi").drop(*names))
    right = known_keys.select(*[F.col(a).alias(b) for a, b in zip(kk, keys)])
    new = df.join(right, keys, "left_anti")
    known = df.join(right, keys, "left_semi")
    return new, known


def normalized_key(c) -> Column:
    """Key text trimmed and lower-cased, for tolerant membership checks."""
    return F.lower(F.trim(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")))


def year_coverage(left: DataFrame, right: DataFrame, year: str,
                  left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Row counts per year on two sides, full outer, with a coverage status."""
    a = left.groupBy(year).agg(F.count(F.lit(1)).alias(f"{left_name}_rows"))
    b = right.groupBy(year).agg(F.count(F.lit(1)).alias(f"{right_name}_rows"))
    j = a.join(b, year, "full_outer")
    lc, rc = F.coalesce(F.col(f"{left_name}_rows"), F.lit(0)), F.coalesce(F.col(f"{right_name}_rows"), F.lit(0))
    return j.select(
        F.col(year), lc.alias(f"{left_name}_rows"), rc.alias(f"{right_name}_rows"),
        F.when((lc > 0) & (rc > 0), "both").when(lc > 0, f"only_{left_name}")
        .otherwise(f"only_{right_name}").alias("coverage"))


def red_blue_link(red: DataFrame, blue: DataFrame, ref: str, blue_key: str,
                  blue_cols=(), blue_order=None) -> DataFrame:
    """Attach the original (blue) invoice to each red invoice by its remark key.

    Only rows with a non-null ``ref`` take part; a red invoice whose blue
    one is absent keeps null blue columns (left join). With ``blue_order`` a
    blue key that comes several times is reduced to its first row, so no red
    invoice multiplies; without it every blue row is attached. Only blue rows
    that a red one refers to are shuffled with their columns, and AQE can
    split the red rows of a popular blue invoice.
    """
    r = red.filter(F.col(ref).isNotNull())
    b = blue.join(r.select(F.col(ref).alias(blue_key)).distinct(), blue_key, "left_semi")
    if blue_order is not None:
        b = first_of_key(b, blue_key, blue_order, list(blue_cols)) if blue_cols else b.select(blue_key).distinct()
    b = b.select(F.col(blue_key).alias(ref), *[F.col(c).alias(f"blue_{c}") for c in blue_cols])
    return join_per_key(r, b, ref, "left")


def first_of_key(df: DataFrame, key: str, order, columns) -> DataFrame:
    """One row per non-null ``key``: ``columns`` of its first row by ``order``
    (ties: the least columns). A minimum, so a repeated key is reduced before
    the shuffle."""
    order, columns = as_list(order), as_list(columns)
    least = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.struct(*columns).alias("row")))
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(least.alias("__least"))
            .select(key, *[F.col(f"__least.row.{c}").alias(c) for c in columns]))


#: steps of a chain of corrections that are followed
MAX_STEPS = 1 << 10
#: bytes of open chains (compressed) that are broadcast
FEW_BYTES = 4 << 20


def correction_chains(invoices: DataFrame, key: str, ref: str, order, max_steps: int = MAX_STEPS) -> DataFrame:
    """For every key that corrects another one (``ref``, of its first row by
    ``order``): ``key, first_key, steps, complete``. The chain of references
    is followed while the referred invoice is itself a correction; it ends at
    the first key that is none, stored or not. A chain that runs in a circle,
    or on after ``max_steps``, is not ``complete`` and stays where it is then.

    Every round doubles the steps: a join of the still open chains with the
    chains so far, so a chain of n corrections takes log2(n) rounds. A chain
    that has reached its end is written once and takes no part in later
    rounds; only the open ones are dealt and written again. A row that refers
    to itself corrects nothing.
    """
    spark = invoices.sparkSession
    base = scratch_path(spark, f"corrections-{uuid.uuid4().hex[:12]}")

    def written(df: DataFrame, n: int) -> DataFrame:
        df.write.option(*STAGE_CODEC).partitionBy("ended").parquet(f"{base}/{n}")
        return spark.read.schema(df.schema).parquet(f"{base}/{n}")

    links = first_of_key(invoices.filter(F.col(ref).isNotNull() & (F.col(ref) != F.col(key))), key, order, [ref])
    open_ = written(links.select(F.col(key).alias("key"), F.col(ref).alias("at"), F.lit(1).cast("long").alias("steps"),
                                 F.lit(False).alias("ended")), 0).drop("ended")
    done = open_.limit(0)
    reached, n = 1, 0
    while True:
        # every chain so far; one that has ended leads a chain that meets it to the end
        ahead = (done.withColumn("ended", F.lit(True)).unionByName(open_.withColumn("ended", F.lit(False)))
                 .select(F.col("key").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"), "ended"))
        if n and stored_bytes(spark, f"{base}/{n}/ended=false") < FEW_BYTES:
            # few are open: only the chains that they meet are dealt
            ahead = ahead.join(F.broadcast(open_.select("at")), "at", "left_semi")
        # a popular invoice is referred to by many: its referrers are split
        met = join_per_key(open_, ahead, "at", "left")
        if reached >= max_steps:
            out = done.withColumn("complete", F.lit(True)).unionByName(
                met.select("key", "at", "steps", F.col("next").isNull().alias("complete")))
            break
        n, reached = n + 1, 2 * reached
        moved = written(met.select("key", F.coalesce("next", "at").alias("at"),
                                   (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                                   F.coalesce("ended", F.lit(True)).alias("ended")), n)
        done = done.unionByName(moved.filter("ended").drop("ended"))
        open_ = moved.filter(~F.col("ended")).drop("ended")
        if not path_exists(spark, f"{base}/{n}/ended=false"):
            out = done.withColumn("complete", F.lit(True))
            break
    return out.select(F.col("key").alias(key), F.col("at").alias("first_key"), "steps", "complete")


def distinct_keys(df: DataFrame, keys) -> DataFrame:
    """Distinct key tuples (null tuples included, as in a set of keys)."""
    return df.select(*as_list(keys)).distinct()
