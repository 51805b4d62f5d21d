"""Identity by several keys, correction chains, near names and routing on small inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens import routing
from ledgerlens.operators import identity as ID
from ledgerlens.operators import joins as J
from ledgerlens.operators.anomaly import similar_names
from ledgerlens.sources import xlsx, xlsx_writer
from scratch import local_scratch_dir


def groups(rows, keys):
    """Row numbers grouped by shared keys, transitively; rows without a key stand alone with None."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(enumerate(rows), 2):
        if any(None not in (x := tuple(a[c] for c in k)) and x == tuple(b[c] for c in k) for k in keys):
            root[find(j)] = find(i)
    return [find(i) if any(None not in tuple(r[c] for c in k) for k in keys) else None for i, r in enumerate(rows)]


def test_identity_over_chains_and_null_keys(spark):
    r = random.Random(4)
    pick = lambda n: r.choice([None, *map(str, range(n))])
    rows = [(i, pick(40), pick(3), pick(60)) for i in range(150)]
    rows += [(200 + i, f"c{i // 2}", "1", f"a{(i + 1) // 2}") for i in range(60)]  # one chain over both keys
    rows += [(300 + i, "hot", "1", None) for i in range(50)] + [(400, None, None, None), (401, None, None, None)]
    rows += [(500, "1|2", "3", None), (501, "1", "2|3", None)]  # texts with the separator stay apart
    df = spark.createDataFrame(rows, "i int, code string, num string, eno string").repartition(4)
    want = groups(rows, [(1, 2), (3,)])
    out = {x.i: x.identity for x in ID.identity(df, [["code", "num"], "eno"]).collect()}
    assert len(out) == len(rows)
    pairs = {(x[0], y[0]) for (x, a), (y, b) in itertools.combinations(zip(rows, want), 2) if a is not None and a == b}
    assert {(x, y) for x, y in itertools.combinations([x[0] for x in rows], 2) if out[x] is not None and out[x] == out[y]} == pairs
    flagged = ID.keep_first_of_identity(df, [["code", "num"], "eno"], ["i"]).collect()
    first = {}
    for x, g in zip(rows, want):
        first.setdefault(g, x[0])
    assert {x.i: x.is_duplicate for x in flagged} == {x[0]: g is not None and first[g] != x[0] for x, g in zip(rows, want)}
    assert ID.identity(df.limit(0), ["code", "eno"]).collect() == []


def test_correction_chains_circles_and_hot_invoices(spark):
    rows = [(f"k{i}", f"k{i - 1}", 0) for i in range(1, 40)]              # one long chain
    rows += [("a", "b", 0), ("b", "c", 0), ("c", "a", 0), ("s", "s", 0)]  # a circle, a row referring to itself
    rows += [(f"h{i}", "hot", 0) for i in range(60)] + [("hot", "first", 1), ("hot", "other", 2), ("n", None, 0), (None, "x", 0)]
    df = spark.createDataFrame(rows, "k string, ref string, nth int").repartition(4)
    out = {r.k: (r.first_key, r.steps, r.complete) for r in J.correction_chains(df, "k", "ref", ["nth"]).collect()}
    assert all(out[f"k{i}"] == ("k0", i, True) for i in range(1, 40))
    assert all(out[f"h{i}"] == ("first", 2, True) for i in range(60)) and out["hot"] == ("first", 1, True)
    assert not any(out[x][2] for x in "abc") and not {"s", "n", None, "k0"} & set(out)
    assert J.correction_chains(df.limit(0), "k", "ref", ["nth"]).collect() == []


def test_red_rows_do_not_multiply(spark):
    blue = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), (None, 1, "n")], "k string, o int, v string")
    red = spark.createDataFrame([(1, "a"), (2, "a"), (3, "q"), (4, None)], "i int, ref string")
    out = J.red_blue_link(red, blue, "ref", "k", ["v"], blue_order=["o"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "y"), (2, "a", "y"), (3, "q", None)]
    assert J.red_blue_link(red, blue, "ref", "k", ["v"]).count() == 5


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_similar_names_by_brute_force(spark, distance):
    r = random.Random(distance)
    names = ["".join(r.choice("ab有限") for _ in range(r.randrange(1, 9))) for _ in range(120)] + ["", "公司", None, "a"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    uniq = spark.createDataFrame([(n,) for n in sorted({n for n in names if n is not None})], "n string")
    want = {(x.a, x.b) for x in uniq.toDF("a").join(uniq.toDF("b"), F.col("a") < F.col("b"))
            .filter(F.levenshtein("a", "b") <= distance).collect()}
    got = similar_names(df, "name", distance).collect()
    assert {(x.name_a, x.name_b) for x in got} == want and len(got) == len(want)
    assert all(x.distance <= distance for x in got)


def test_name_variants_are_not_broadcast(spark):
    df = spark.range(500).select(F.substring(F.md5(F.col("id").cast("string")), 1, 12).alias("name"))
    out = similar_names(df, "name", 2)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()  # what ran in the end
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


SCHEMAS = {"header": ["code", "number", "total"], "detail": ["code", "number", "price", "amount"], "special_toll": ["plate"]}


def test_routes(spark):
    rows = [("HEADER__1", ["price", "amount"]), ("header__x", []), ("toll__1", ["code"]), ("TEMP__a", ["code", "number"]),
            ("TEMP_TRANSIT__a", ["plate"]), ("x", ["code", "number"]), ("x", ["code", "amount"]), ("x", ["plate", "z"]), ("x", ["z"]),
            ("x", None), ("nope__1", ["plate"]), ("__1", ["plate"]), ("HEADER", ["plate"])]
    cat = spark.createDataFrame([("f", i, *r) for i, r in enumerate(rows)], "file string, i int, sheet string, columns array<string>")
    out = [(r.target_table, r.route, r.overlap) for r in routing.route_sheets(cat, SCHEMAS).orderBy("i").collect()]
    assert out == [("header", "prefix", 0), ("header", "prefix", 0), ("special_toll", "prefix", 0), ("transit", "prefix", 0),
                   ("transit", "prefix", 0), ("header", "overlap", 2), ("detail", "overlap", 2), ("special_toll", "overlap", 1),
                   ("transit", "transit", 0), ("transit", "transit", 0), ("special_toll", "overlap", 1),
                   ("special_toll", "overlap", 1), ("special_toll", "overlap", 1)]
    few = [r.target_table for r in routing.route_sheets(cat, SCHEMAS, min_overlap=2).orderBy("i").collect()]
    assert few[5:10] == ["header", "detail", "transit", "transit", "transit"]


def test_routed_rows_once_and_a_batch_replaces_itself(spark):
    folder, path, staged = local_scratch_dir(), local_scratch_dir(), local_scratch_dir()
    text = lambda *t: [F.concat(F.lit(f"{c}-"), F.col("id").cast("string")).alias(c) for c in t]
    for i, (sheet, titles) in enumerate([("a", ("code", "number", "extra")), ("b", ("plate", "z")), ("c", ("p", "q"))]):
        xlsx_writer.write_workbooks(spark.range(10 * (i + 1)).select(*text(*titles)).coalesce(1), f"{folder}/{i}", sheet).count()
    for _ in range(2):
        routed, folders, errors = routing.import_routed(spark, folder, path, SCHEMAS, "b1", f"{staged}/rows")
        assert {t: spark.read.parquet(p).count() for t, p in folders.items()} == {"header": 10, "special_toll": 20, "transit": 30}
    header = spark.read.parquet(folders["header"])
    assert header.columns == ["source_file", "source_sheet", "row_no", "route", "code", "number", "total", "import_batch_id"]
    assert {r.code for r in header.collect()} == {f"code-{i}" for i in range(10)} and header.filter("total is not null").isEmpty()
    waiting = spark.read.parquet(folders["transit"]).orderBy("row_no").first()
    assert waiting["values"] == {"p": "p-0", "q": "q-0"} and errors.count() == 0 and routed.count() == 3
    assert xlsx.sheet_catalogue(spark.read.schema(xlsx.ROW_SCHEMA).parquet(f"{staged}/rows")).count() == 3


def test_ended_chains_take_no_part_in_later_rounds(spark, monkeypatch):
    dealt, join = [], J.join_per_key

    def counted(rows, *a):
        dealt.append(rows.count())
        return join(rows, *a)

    monkeypatch.setattr(J, "join_per_key", counted)
    rows = [(f"k{i}", f"k{i - 1}", 0) for i in range(1, 41)] + [(f"s{i}", f"t{i}", 0) for i in range(100)] + [("a", "b", 0), ("b", "a", 0)]
    df = spark.createDataFrame(rows, "k string, ref string, nth int")
    out = {r.k: (r.first_key, r.steps, r.complete) for r in J.correction_chains(df, "k", "ref", ["nth"], max_steps=64).collect()}
    assert all(out[f"k{i}"] == ("k0", i, True) for i in range(1, 41)) and all(out[f"s{i}"] == (f"t{i}", 1, True) for i in range(100))
    assert not out["a"][2] and not out["b"][2] and len(out) == 142
    assert dealt[0] == 142 and dealt[1] <= 41 and dealt[-1] == 2
