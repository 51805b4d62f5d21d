"""Related parties: buyers and sellers that share a tax id, a name or another mark.

Marks, not parties, carry the search: two parties are related directly when
they share a mark, over one party between them when a third party carries a
mark of each, and at all when a chain of shared marks links them. The first
two are equi-joins of an invoice pair's own few marks, the last one the
connected components of the marks, so a mark that a third of all parties
carry produces no pairs of parties.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.identity import components, key_node
from ledgerlens.operators.joins import as_list, join_per_key

DIRECT, ONE_BETWEEN, LINKED = "direct", "one_between", "linked"


def party_marks(parties: DataFrame, party: str, marks: list) -> DataFrame:
    """Distinct ``party, mark`` rows; null marks are none."""
    nodes = F.array_compact(F.array(*[key_node(i, m) for i, m in enumerate(marks)]))
    return parties.select(F.col(party).alias("party"), F.explode(nodes).alias("mark")).distinct()


def trade_pairs(invoices: DataFrame, seller: str, buyer: str, amount: str) -> DataFrame:
    """One row per seller and buyer: invoices and amount in this direction and
    in the other one (0 where there is none)."""
    low, high = F.least(seller, buyer), F.greatest(seller, buyer)
    forward = F.col(seller) == low
    rows = invoices.filter(F.col(seller).isNotNull() & F.col(buyer).isNotNull() & (F.col(seller) != F.col(buyer)))
    money = F.col(amount).cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    both = rows.groupBy(low.alias("low"), high.alias("high")).agg(
        F.count_if(forward).alias("n_up"), F.count_if(~forward).alias("n_down"),
        F.sum(F.when(forward, money).otherwise(zero)).alias("a_up"), F.sum(F.when(forward, zero).otherwise(money)).alias("a_down"))
    way = lambda s, b, n, a, rn, ra: F.struct(
        F.col(s).alias("seller"), F.col(b).alias("buyer"), F.col(n).alias("invoices"), F.col(a).alias("amount"),
        F.col(rn).alias("reverse_invoices"), F.col(ra).alias("reverse_amount"))
    ways = F.array(way("low", "high", "n_up", "a_up", "n_down", "a_down"), way("high", "low", "n_down", "a_down", "n_up", "a_up"))
    return both.select(F.explode(ways).alias("w")).select("w.*").filter("invoices > 0")


def related_party_pairs(invoices: DataFrame, parties: DataFrame, seller: str, buyer: str, amount: str, party: str,
                        marks: list, max_between: int | None = 1) -> DataFrame:
    """The trade pairs whose parties are related: ``seller, buyer, invoices,
    amount, reverse_invoices, reverse_amount, relation``. ``relation`` is
    'direct' (a shared mark), 'one_between' (over one more party) or 'linked'
    (over more). ``max_between`` 0 or 1 bounds the parties between; None asks
    for chains of any length. ``marks`` are columns or lists of columns of
    ``parties``; a party may come in several rows."""
    if max_between not in (0, 1, None):
        raise ValueError("max_between must be 0, 1 or None")
    pairs = trade_pairs(invoices, seller, buyer, amount)
    own = party_marks(parties, party, as_list(marks))
    # the marks of a pair's two sides: few rows a pair
    sides = join_per_key_many(pairs.select("seller", "buyer"), own, "seller", "mark_s")
    sides = join_per_key_many(sides, own, "buyer", "mark_b")
    found = [sides.filter("mark_s = mark_b").select("seller", "buyer", F.lit(0).alias("far"))]
    if max_between != 0:
        # marks that one party carries together
        beside = own.withColumnRenamed("mark", "mark_s").join(own.withColumnRenamed("mark", "mark_b"), "party")
        beside = beside.filter("mark_s <> mark_b").select("mark_s", "mark_b").distinct()
        # both are marks of the pair itself, so this looks up pairs of marks and expands none
        found.append(sides.join(beside, ["mark_s", "mark_b"], "left_semi").select("seller", "buyer", F.lit(1)))
    if max_between is None:
        first = own.groupBy("party").agg(F.min("mark").alias("first"))
        links = own.join(first, "party").select(F.col("first").alias("a"), F.col("mark").alias("b"))
        root = components(links)
        group = first.join(root, F.col("first") == F.col("node"), "left").select("party", F.coalesce("root", "first").alias("group"))
        s = join_per_key_many(pairs.select("seller", "buyer"), group.withColumnRenamed("group", "mark"), "seller", "group_s")
        s = join_per_key_many(s, group.withColumnRenamed("group", "mark"), "buyer", "group_b")
        found.append(s.filter("group_s = group_b").select("seller", "buyer", F.lit(2)))
    near = reduce(DataFrame.union, found).groupBy("seller", "buyer").agg(F.min("far").alias("far"))
    relation = F.element_at(F.array(F.lit(DIRECT), F.lit(ONE_BETWEEN), F.lit(LINKED)), F.col("far") + 1)
    return pairs.join(near, ["seller", "buyer"]).select(*pairs.columns, relation.alias("relation"))


def join_per_key_many(rows: DataFrame, marks: DataFrame, column: str, out: str) -> DataFrame:
    """``rows`` with a row per mark of the party in ``column``; a party that
    trades with a third of all others can be split."""
    return join_per_key(rows, marks.select(F.col("party").alias(column), F.col("mark").alias(out)), column)
