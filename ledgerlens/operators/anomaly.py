"""Audit rules over the ledger: tax-rate anomalies and the documented
extra rules (amount arithmetic, seller consistency, similar names, first
transactions, month-end concentration, number gaps, price deviation,
monthly rollup, blacklist hits).

All rules are aggregations or equi-joins; none pairs rows inside a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.joins import as_list, join_per_key

# re-exported: the two rate rules live with the other filters
from ledgerlens.operators.filters import tax_rate_anomaly, tax_rate_unexpected  # noqa: F401


def amount_anomaly(df: DataFrame, amount: str, rate: str, tax: str, total: str,
                   is_red: Column | None = None, tolerance: str = "0.01") -> DataFrame:
    """One row per (invoice line, broken rule).

    'tax_mismatch': |tax - round(amount * rate, 2)| > tolerance;
    'total_mismatch': total <> amount + tax;
    'negative_amount': amount < 0 on a non-red invoice.
    """
    a, r, t, tot = F.col(amount), F.col(rate), F.col(tax), F.col(total)
    tol = F.lit(tolerance).cast("decimal(18,2)")
    red = F.coalesce(is_red, F.lit(False)) if is_red is not None else F.lit(False)
    rules = F.array(
        F.when(F.abs(t - F.round(a * r, 2)) > tol, F.lit("tax_mismatch")),
        F.when(tot != a + t, F.lit("total_mismatch")),
        F.when((a < 0) & ~red, F.lit("negative_amount")))
    hits = F.array_compact(rules)
    return df.withColumn("rule", F.explode(hits))


def seller_rate_inconsistent(df: DataFrame, seller: str, rate: str, year: str) -> DataFrame:
    """Sellers that used more than one rate, with the years spanned."""
    return (df.groupBy(seller)
            .agg(F.count_distinct(F.col(rate)).alias("distinct_rates"),
                 F.min(year).alias("first_year"), F.max(year).alias("last_year"))
            .filter(F.col("distinct_rates") > 1))


def _deletion_variants(name: Column) -> Column:
    """The name itself and every string with one character removed."""
    n = F.length(name)
    dels = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                       lambda i: F.concat(name.substr(F.lit(1), i - 1), name.substr(i + 1, n)))
    return F.array_union(F.array(name), dels)


def similar_names(df: DataFrame, name: str, max_distance: int = 1) -> DataFrame:
    """Pairs of distinct names within Levenshtein distance ``max_distance``
    (1 to 3).

    Candidates come from an equi-join on deletion variants (two names within
    distance d share a text that is left of each after at most d characters
    are removed), over distinct names, so copies of one name never multiply.
    Names that share a variant are within twice the distance, so a group of
    candidates is one of near names, never all that share a common word; for
    variants per name the price is about ``length ** d / d!``. Each pair is
    verified with ``levenshtein``. Null names match nothing.
    Output: name_a < name_b, distance, and how many rows carry each name.
    """
    if max_distance not in (1, 2, 3):
        raise ValueError("max_distance must be 1, 2 or 3")
    names = df.groupBy(F.col(name).alias("nm")).agg(F.count(F.lit(1)).alias("rows"))
    names = names.filter(F.col("nm").isNotNull())
    variants = _deletion_variants(F.col("nm"))
    for _ in range(max_distance - 1):
        variants = F.array_distinct(F.flatten(F.transform(variants, _deletion_variants)))
    # the names are few bytes and their variants a hundred times as many: dealt to tasks before they
    # unfold, met by a hash of the text, and never broadcast, whatever size Spark measures for the names
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = (names.repartition(tasks, F.xxhash64("nm")).select("nm", "rows", F.explode(variants).alias("variant"))
         .select("nm", "rows", F.xxhash64("variant").alias("variant")))
    a = v.select(F.col("nm").alias("name_a"), F.col("rows").alias("rows_a"), "variant")
    b = v.select(F.col("nm").alias("name_b"), F.col("rows").alias("rows_b"), "variant").hint("merge")
    near = F.levenshtein("name_a", "name_b", max_distance)
    pairs = (a.join(b, "variant").filter((F.col("name_a") < F.col("name_b")) & (near >= 0))
             .select("name_a", "name_b", "rows_a", "rows_b").distinct())
    return pairs.withColumn("distance", F.levenshtein("name_a", "name_b"))


def first_transactions(df: DataFrame, party: str, order, amount: str, threshold) -> DataFrame:
    """First transaction of each party (by ``order``, a total order) when its
    amount exceeds ``threshold``. A minimum of (order, amount) per party is a
    partial aggregate, so a party's rows never meet in one task."""
    ordcols = [c for c in as_list(order) if c != party]
    cols = [*ordcols, *([amount] if amount not in ordcols else [])]
    first = df.groupBy(party).agg(F.min(F.struct(*cols)).alias("__first"))
    return (first.select(party, *[F.col(f"__first.{c}").alias(c) for c in cols])
            .filter(F.col(amount) > F.lit(threshold)))


def month_end_concentration(df: DataFrame, party: str, date: str, last_days: int = 3,
                            threshold: float = 0.3) -> DataFrame:
    """Per party: rows, rows in the last ``last_days`` days of a month, ratio,
    and a flag when the ratio exceeds ``threshold``."""
    d = F.to_date(F.col(date))
    month_end = F.dayofmonth(d) > F.dayofmonth(F.last_day(d)) - last_days
    g = df.groupBy(party).agg(F.count(F.lit(1)).alias("rows"), F.count_if(month_end).alias("month_end_rows"))
    return g.withColumns({"ratio": F.round(F.col("month_end_rows") / F.col("rows"), 4),
                          "concentrated": F.col("month_end_rows") > F.col("rows") * threshold})


def number_gaps(df: DataFrame, series: str, number: str, bucket: int = 10_000) -> DataFrame:
    """Gaps in the numbers of each series: (series, gap_after, next_number, missing).

    Exact and skew-safe: numbers are de-duplicated, the lag runs inside
    fixed ranges of ``bucket`` numbers, each range is then one (least,
    greatest) row and the lag runs over these inside ranges of ``bucket``
    ranges, and last over the few rows that are left of a series. A window
    holds at most ``bucket`` rows, but for series of more than ``bucket``**3
    numbers.
    """
    n = F.col(number).cast("bigint")
    rows = df.select(F.col(series), n.alias("__lo")).filter(F.col("__lo").isNotNull()).distinct() \
        .withColumn("__hi", F.col("__lo"))
    gaps = None
    for width in (bucket, bucket * bucket, None):
        part = [series] if width is None else [series, "__b"]
        if width is not None:
            rows = rows.withColumn("__b", F.floor(F.col("__lo") / width))
        w = Window.partitionBy(*part).orderBy("__lo")
        found = (rows.withColumn("__prev", F.lag("__hi").over(w)).filter(F.col("__lo") - F.col("__prev") > 1)
                 .select(series, F.col("__prev").alias("gap_after"), F.col("__lo").alias("next_number")))
        gaps = found if gaps is None else gaps.unionByName(found)
        rows = rows.groupBy(*part).agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")).drop("__b")
    return gaps.withColumn("missing", F.col("next_number") - F.col("gap_after") - 1)


def price_deviation(df: DataFrame, group: str, amount: str, quantity: str,
                    max_rel: str = "0.5") -> DataFrame:
    """Rows whose unit price (amount / quantity) deviates from the group's
    market price (sum amount / sum quantity) by more than ``max_rel``.

    Tested exactly in DECIMAL without division:
    |amount * Sq - qty * Sa| > max_rel * qty * Sa (rows with qty > 0).
    Group sums are partial aggregates, joined back in a join that AQE can
    split (``join_per_key``).
    """
    d = df.filter(F.col(quantity) > 0)
    j = join_per_key(d, d.groupBy(group).agg(F.sum(amount).alias("group_amount"), F.sum(quantity).alias("group_qty")),
                     group)
    a, q = F.col(amount), F.col(quantity)
    dev = F.abs(a * F.col("group_qty") - q * F.col("group_amount"))
    limit = F.lit(max_rel).cast("decimal(4,2)") * q * F.col("group_amount")
    return j.filter((F.col("group_amount") > 0) & (dev > limit))


def monthly_rollup(df: DataFrame, date: str, sums: dict[str, str], by=(), dtype="decimal(18,2)") -> DataFrame:
    """Per month (and ``by``): row count and sums."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for out, c in sums.items():
        aggs.append(F.coalesce(F.sum(F.col(c).cast(dtype)), F.lit(0)).alias(out))
    return df.groupBy(F.trunc(F.col(date), "MM").alias("month"), *as_list(by)).agg(*aggs)


def blacklist_hits(df: DataFrame, blacklist: DataFrame, key: str, black_key: str | None = None) -> DataFrame:
    """Rows whose party is on the blacklist (semi join; Spark broadcasts the
    list when its size in bytes allows)."""
    bk = blacklist.select(F.col(black_key or key).alias(key)).distinct()
    return df.join(bk, key, "left_semi")


def date_before_business(df: DataFrame, invoice_date: str, business_date: str) -> DataFrame:
    """Rows whose invoice date is earlier than the business date."""
    return df.filter(F.to_date(F.col(invoice_date)) < F.to_date(F.col(business_date)))
