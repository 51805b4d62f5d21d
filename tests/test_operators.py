"""Invariants of the dedup, quarantine and reconciliation operators."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.operators import dedup as D
from ledgerlens.operators import filters as FL
from ledgerlens.operators import quality as Q
from ledgerlens.plans.tables import line_order, table


def test_build_ledger_partitions_input(spark, sf_small):
    li = table(spark, sf_small, "lineitem")
    ledger, dups = D.build_ledger(li, ["l_orderkey", "l_linenumber"], line_order())
    n = li.count()
    assert ledger.count() + dups.count() == n
    assert ledger.select("l_orderkey", "l_linenumber").distinct().count() == ledger.count()
    # every duplicate has its key in the ledger
    assert dups.join(ledger, ["l_orderkey", "l_linenumber"], "left_anti").count() == 0


def test_flag_duplicates_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, o int")
    flagged = {r.o: r.is_duplicate for r in D.flag_duplicates(df, ["k"], ["o"]).collect()}
    assert flagged == {1: False, 2: True, 3: False}
    last = {r.o: r.is_duplicate for r in D.flag_duplicates(df, ["k"], ["o"], keep="last").collect()}
    assert last == {1: True, 2: False, 3: False}


def test_quarantine_invariants(spark, sf_small):
    li = table(spark, sf_small, "lineitem", "l_orderkey", "l_linenumber", *line_order())
    keys = ["l_orderkey", "l_linenumber"]
    acc, held = D.quarantine(li, keys)
    assert acc.count() + held.count() == li.count()
    # accepted keys are unique and never among the quarantined keys
    assert acc.select(*keys).distinct().count() == acc.count()
    assert acc.join(held, keys, "left_semi").count() == 0
    # importing the accepted rows again: everything is already known
    acc2, held2 = D.quarantine(acc, keys, known_keys=acc)
    assert acc2.count() == 0 and held2.count() == acc.count()
    assert {r.quarantine_reason for r in held2.select("quarantine_reason").distinct().collect()} == {"already_imported"}


def test_quarantine_keep_first(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, o int")
    acc, held = D.quarantine(df, "k", mode="keep_first", order=["o"])
    assert sorted(r.o for r in acc.collect()) == [1, 3]
    assert [r.o for r in held.collect()] == [2]


def test_valid_invoice_keys_all_combinations(spark):
    vals = [None, "", " "]
    rows, i = [], 0
    for c in vals + ["C"]:
        for n in vals + ["N"]:
            for e in vals + ["E"]:
                rows.append((i, c, n, e))
                i += 1
    df = spark.createDataFrame(rows, "i int, c string, n string, e string")
    ok, bad = FL.valid_invoice_keys(df, "c", "n", "e")
    assert ok.count() + bad.count() == df.count()
    for r in bad.collect():
        has = [x not in vals for x in (r.c, r.n, r.e)]
        assert not has[2] and (not any(has) or has[0] != has[1])
    for r in ok.collect():
        has = [x not in vals for x in (r.c, r.n, r.e)]
        assert has[2] or (has[0] and has[1])


def test_balance_check_states(spark):
    header = spark.createDataFrame(
        [("h1", Decimal("10.00"), None, "未校验", None), ("h2", Decimal("10.05"), None, "未校验", None),
         ("h3", Decimal("10.20"), None, "未校验", None), ("h4", Decimal("10.20"), None, "强制通过", None),
         ("h5", Decimal("10.00"), None, "未校验", None), ("h6", Decimal("10.15"), Decimal("0.20"), "未校验", None),
         ("h7", Decimal("10.00"), None, "未校验", "UUID重复")],
        "k string, jshj decimal(18,2), balance_tolerance decimal(18,2), is_balanced string, clean_status string")
    detail = spark.createDataFrame(
        [("h1", Decimal("4.00")), ("h1", Decimal("6.00")), ("h2", Decimal("10.00")), ("h3", Decimal("10.00")),
         ("h4", Decimal("10.00")), ("h6", Decimal("10.00")), ("h7", Decimal("10.00")), ("h5", None)],
        "k string, jshj decimal(18,2)")
    out = {r.k: r for r in Q.balance_check(header, detail, "k", checked_at="2024-01-01 00:00:00",
                                           checked_by="t").collect()}
    assert out["h1"].is_balanced == "平账" and out["h1"].balance_check_by == "t"
    assert out["h2"].is_balanced == "差异可接受"
    assert out["h3"].is_balanced == "不平账"
    assert out["h4"].is_balanced == "强制通过" and out["h4"].balance_check_by is None
    # all-null detail amounts sum to 0
    assert out["h5"].detail_total_amount == Decimal("0.00") and out["h5"].is_balanced == "不平账"
    assert out["h6"].is_balanced == "差异可接受"
    assert out["h7"].is_balanced == "未校验" and out["h7"].balance_diff is None


def test_run_dq_sticky_and_orphans(spark):
    ts = dt.datetime(2024, 1, 1)
    header = spark.createDataFrame(
        [("A", ts, None, "未校验", Decimal("5.00")), ("A", ts + dt.timedelta(1), None, "未校验", Decimal("5.00")),
         ("B", ts, None, "未校验", Decimal("1.00")), ("C", ts, "明细缺失", "未校验", Decimal("1.00"))],
        "header_uuid string, created_at timestamp, clean_status string, is_balanced string, jshj decimal(18,2)")
    detail = spark.createDataFrame(
        [("d1", "A", ts, None, Decimal("5.00")), ("d2", "Z", ts, None, Decimal("1.00")),
         ("d2", "Z", ts + dt.timedelta(1), None, Decimal("1.00"))],
        "detail_uuid string, header_uuid string, updated_at timestamp, clean_status string, jshj decimal(18,2)")
    h, d = Q.run_dq(header, detail)
    hs = sorted((r.header_uuid, r.created_at, r.clean_status, r.is_balanced) for r in h.collect())
    assert hs[0][2] is None and hs[0][3] == "平账"
    assert hs[1][2] == "UUID重复"
    assert hs[2][2] == "明细缺失"          # B has no detail
    assert hs[3][2] == "明细缺失"          # sticky
    ds = sorted((r.detail_uuid, r.updated_at, r.clean_status) for r in d.collect())
    assert ds[0][2] is None and ds[1][2] == "主表缺失" and ds[2][2] == "UUID重复"


def test_number_gaps_across_buckets(spark):
    nums = [1, 2, 3, 7, 8, 15, 16, 40, 41, 41]
    df = spark.createDataFrame([("s", n) for n in nums] + [("t", 5), ("t", 9)], "s string, n long")
    from ledgerlens.operators.anomaly import number_gaps
    for bucket in (4, 10, 1000):
        got = sorted((r.s, r.gap_after, r.next_number, r.missing) for r in number_gaps(df, "s", "n", bucket).collect())
        assert got == [("s", 3, 7, 3), ("s", 8, 15, 6), ("s", 16, 40, 23), ("t", 5, 9, 3)]


def test_similar_names_matches_brute_force(spark):
    names = ["acme", "acne", "acme", "bcme", "acm", "zzzz", "acmee", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    from ledgerlens.operators.anomaly import similar_names
    got = {(r.name_a, r.name_b) for r in similar_names(df, "name").collect()}

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]
    uniq = sorted({n for n in names if n})
    want = {(a, b) for a in uniq for b in uniq if a < b and lev(a, b) <= 1}
    assert got == want


def test_top_n_uses_window_group_limit(spark, sf_small, capsys):
    li = table(spark, sf_small, "lineitem")
    out = D.top_n_per_group(li, "l_suppkey", [F.desc("l_extendedprice"), F.asc("l_orderkey")], 3)
    out.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def task_rows(spark, df, columns):
    """Rows of ``df`` per group of the given window partitioning, largest first."""
    return [r[0] for r in df.groupBy(*columns).count().select("count").orderBy(F.desc("count")).collect()]


def test_hot_key_is_spread_over_salts(spark, sf_small, capsys):
    """A third of the lines share one key. Every window is partitioned by the
    key and a salt or a level, no job runs while the plan is built, and the
    flags equal those of a window over the whole key."""
    from pyspark.sql import Window
    from ledgerlens.plans.bind_dedup import _hot_lines
    li, order = _hot_lines(spark, sf_small), line_order() + ["l_linenumber"]
    total = li.count()
    for keep, sort in (("first", [F.asc(c) for c in order]), ("last", [F.desc(c) for c in order])):
        flagged = D.group_flags(li, "hot_key", order, keep)
        w = Window.partitionBy("hot_key")
        plain = li.withColumns({"__repeated": F.count(F.lit(1)).over(w) > 1,
                                "__is_first": F.row_number().over(w.orderBy(*sort)) == 1})
        assert flagged.columns == plain.columns
        assert sorted(map(str, flagged.collect())) == sorted(map(str, plain.collect()))
    flagged.explain()
    plan = capsys.readouterr().out
    assert "__salt" in plan and "__level" in plan and "Join" not in plan
    salted = li.withColumn("s", F.pmod(D._row_hash(li), F.lit(D.SALTS)))
    assert task_rows(spark, li, ["hot_key"])[0] >= 0.3 * total and task_rows(spark, salted, ["hot_key", "s"])[0] < total / 100


def test_group_flags_of_ties_and_nulls(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "x"), ("b", 2, "y"), (None, 1, "z"), (None, 2, "z"), ("c", 1, "p"), ("c", 1, "q")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(3)
    out = D.group_flags(df, "k", ["o"]).collect()
    assert [sum(r["__is_first"] for r in out if r.k == k) for k in ("a", "b", "c", None)] == [1, 1, 1, 1]
    assert {r.k for r in out if r["__repeated"]} == {"a", "c", None}
    assert [r.o for r in out if r.k is None and r["__is_first"]] == [1]
    alone = D.group_flags(df, "k").collect()
    assert sum(r["__is_first"] for r in alone) == 4 and sum(r["__repeated"] for r in alone) == 7
    assert D.group_flags(df.limit(0), "k", ["o"]).collect() == []


def test_line_numbers_of_a_hot_invoice(spark, sf_small):
    from pyspark.sql import Window
    from ledgerlens.plans.bind_dedup import _hot_lines
    li, order = _hot_lines(spark, sf_small), line_order() + ["l_linenumber", "l_orderkey"]
    li = li.withColumn("hot_key", F.when(F.col("l_orderkey") % 11 != 5, F.col("hot_key")))  # null keys too
    w = Window.partitionBy("hot_key").orderBy(*order)
    want = li.withColumn("n", F.row_number().over(w))
    got = D.logic_line_no(li.repartition(6), "hot_key", order, scope=(), out="n")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert D.logic_line_no(li.limit(0), "hot_key", order, scope=(), out="n").collect() == []


def test_per_key_join_has_its_own_exchanges(spark, sf_small):
    """A hot key's rows can be split only if both sides are dealt for the join."""
    from ledgerlens.operators.joins import join_per_key
    from ledgerlens.plans.bind_dedup import _hot_lines
    li = _hot_lines(spark, sf_small).withColumn("amt", F.col("l_extendedprice").cast("decimal(18,2)"))
    sums = li.groupBy("hot_key").agg(F.sum("amt").alias("s"), F.count("amt").alias("n"))
    want = {tuple(r) for r in li.join(sums, "hot_key").select(*li.columns, "s", "n").collect()}
    got = join_per_key(li, sums, "hot_key")
    assert {tuple(r) for r in got.select(*li.columns, "s", "n").collect()} == want
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join_per_key(li, sums, "hot_key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.count("__key_hash") > 0 and plan.count("ENSURE_REQUIREMENTS") >= 3


def test_results_independent_of_row_order_and_partitions(spark, sf_small):
    from ledgerlens.operators.anomaly import number_gaps, similar_names
    li = table(spark, sf_small, "lineitem")
    shuffled = li.repartition(7).orderBy(F.rand(5))
    keys = ["l_orderkey", "l_linenumber"]

    def run(df):
        ledger, dups = D.build_ledger(df, keys, line_order())
        acc, held = D.quarantine(df.select(*keys, *line_order()), keys)
        totals = Q.detail_total_per_header(df, "l_orderkey", "l_extendedprice")
        gaps = number_gaps(df, "l_suppkey", "l_orderkey", bucket=100)
        lines = D.logic_line_no(df, "l_orderkey", line_order(), scope=())
        return [{tuple(r) for r in x.collect()} for x in (ledger, dups, acc, held, totals, gaps, lines)]

    assert run(li) == run(shuffled)
    names = table(spark, sf_small, "supplier", "s_name")
    assert {tuple(r) for r in similar_names(names, "s_name").collect()} == \
        {tuple(r) for r in similar_names(names.repartition(3), "s_name").collect()}


def test_parsing_once_gives_the_same_records(spark, sf_small):
    from ledgerlens.operators import audit
    from ledgerlens.plans import bind_audit as B
    rows = B._sheet_rows(spark, sf_small)
    odd = [("f", "s", 1, None, "x", "免税", "9"), ("f", "s", 2, "", " ", "", None), ("g", "s", 3, "2024-02-30", "1,5e", "13%%", ""),
           ("g", "t", 4, "20240229", "-1.5", "不征税", "1"), ("g", "t", 5, "nope", None, "abc", "2")]
    cols = ["file", "sheet", "row_index", "开票日期", "金额", "税率", "发票号码"]
    rows = rows.select(*cols).union(spark.createDataFrame(odd, rows.select(*cols).schema))
    typed, stats, failures = audit.cast_and_record(rows, B.SPECS, keys=["发票号码"])
    parsed = audit.parse_once(rows, B.SPECS)
    for got, want in ((audit.typed_from(parsed, B.SPECS), typed), (audit.stats_from(parsed, B.SPECS), stats),
                      (audit.failures_from(parsed, B.SPECS, keys=["发票号码"]), failures)):
        assert got.columns == want.columns and got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_failures_read_their_column_once_per_test(spark):
    """A filter evaluates an expression once per reference to it: the raw text is built at most
    three times (as date, as serial day, as blank), not once per comparison."""
    from ledgerlens.functions.parse import parse_invoice_date
    from ledgerlens.operators import audit
    df = spark.createDataFrame([(1, "2024-1-5"), (2, " "), (3, None), (4, "x"), (5, "00012345"), (6, "45000"), (7, "20241301")], "n int, t string")
    raw = df.select("n", F.lit("f").alias("file"), F.lit("s").alias("sheet"), F.upper("t").alias("d"), F.upper("t").alias("m"))
    for column, kind, most in (("d", audit.DATE, 3), ("m", audit.NUMERIC, 2)):
        out = audit.cast_failures(raw, {column: kind}, row="n")
        lines = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
        assert sum(x.count("upper(") for x in lines) <= most, lines
    assert sorted((r.n, r.orig_value) for r in audit.cast_failures(raw, {"d": audit.DATE}, row="n").collect()) == \
        [(4, "X"), (5, "00012345"), (7, "20241301")]
    assert [str(r[0]) for r in df.orderBy("n").select(parse_invoice_date("t")).collect()] == \
        ["2024-01-05", "None", "None", "None", "None", "2023-03-15", "None"]
