"""Streaming workbooks against one batch import; related parties against plain search."""

import itertools
import os
import random

from pyspark.sql import functions as F

from ledgerlens import ingest
from ledgerlens.operators import parties as P
from ledgerlens.plans import bind_io
from ledgerlens.sources import xlsx_writer
from ledgerlens.streaming.workbooks import import_workbooks, start_workbook_import
from scratch import local_scratch_dir


def stream(spark, landing, base, files=1):
    start_workbook_import(spark, landing, "header", f"{base}/ledger", f"{base}/side", f"{base}/checkpoint", "s",
                          "2024-01-01 00:00:00", max_files_per_trigger=files, max_mb=5.0).awaitTermination()
    return spark.read.parquet(f"{base}/ledger")


def test_stream_equals_batch_and_goes_on(spark, sf_small):
    landing, base = local_scratch_dir(), local_scratch_dir()
    rows = bind_io.header_export(spark, sf_small)
    one, two = rows.filter(F.length('价税合计') % 2 == 0), rows
    xlsx_writer.write_workbooks(one.repartition(2), f"{landing}/a", "发票基础信息").count()
    with open(f"{landing}/broken.xlsx", "wb") as f:
        f.write(b"no workbook")
    with open(f"{landing}/old.xls", "wb") as f:
        f.write(b"old")
    with open(f"{landing}/large.xlsx", "wb") as f:
        f.write(b"0" * (6 << 20))
    first = stream(spark, landing, base)
    assert first.count() == first.select("header_uuid").distinct().count() > 0
    errors = {os.path.basename(r.file): r.error_type for r in spark.read.parquet(f"{base}/side/errors").collect()}
    assert set(errors) == {"broken.xlsx", "old.xls", "large.xlsx"} and errors["large.xlsx"] == "FileTooLarge"
    xlsx_writer.write_workbooks(two.repartition(2), f"{landing}/b", "发票基础信息").count()  # all rows of the first drop again
    after = stream(spark, landing, base, files=3)
    batch = ingest.import_headers(spark, landing, "b", "2024-01-01 00:00:00", mode="keep_first", max_mb=5.0)
    assert sorted(r.header_uuid for r in after.collect()) == sorted(r.header_uuid for r in batch.accepted.collect())
    held = spark.read.parquet(f"{base}/side/quarantine").count()
    assert after.count() + held == batch.accepted.count() + batch.quarantined.count()
    assert spark.read.parquet(f"{base}/side/rejected").count() == batch.rejected_keys.count() + batch.missing_year.count()


def test_a_repeated_micro_batch_replaces_itself(spark, sf_small):
    landing, base = local_scratch_dir(), local_scratch_dir()
    xlsx_writer.write_workbooks(bind_io.detail_export(spark, sf_small, parts=2), landing, "信息汇总表").count()
    files = spark.read.format("binaryFile").load(landing)
    for _ in range(2):
        import_workbooks(files, 0, "detail", f"{base}/ledger", f"{base}/side", "s", "2024-01-01 00:00:00")
    out = spark.read.parquet(f"{base}/ledger")
    assert out.count() == spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    import_workbooks(files, 1, "detail", f"{base}/ledger", f"{base}/side", "s", "2024-01-01 00:00:00")
    assert spark.read.parquet(f"{base}/ledger").filter("import_epoch = 1").count() == 0


def test_related_parties_by_brute_force(spark):
    r = random.Random(7)
    parties = [(f"p{i}", r.choice([None, *(f"t{k}" for k in range(25))]), r.choice([None, *(f"n{k}" for k in range(30))])) for i in range(60)]
    parties += [("p1", "t1", None), (None, "t2", "n2")] + [(f"q{i}", f"c{i}", f"d{i // 2}") for i in range(12)]
    parties += [(f"q{i}", f"e{(i + 1) // 2}", None) for i in range(12)]  # a chain
    trade = [(f"p{r.randrange(60)}", f"p{r.randrange(60)}", r.randrange(1, 9)) for _ in range(400)]
    trade += [("q0", f"q{i}", 1) for i in range(1, 12)] + [("p0", None, 5), (None, "p0", 5), ("unknown", "p3", 5)]
    marks = {}
    for p, t, n in parties:
        if p is not None:
            marks.setdefault(p, set()).update(x for x in (("t", t), ("n", n)) if x[1] is not None)

    def far(a, b):
        seen, edge, n = set(), set(marks.get(a, ())), 0
        while edge:
            if edge & marks.get(b, set()):
                return n
            seen |= edge
            edge = set(itertools.chain.from_iterable(m for m in marks.values() if m & edge)) - seen
            n += 1
        return None

    sums = {}
    for s, b, a in trade:
        if s and b and s != b:
            n, t = sums.get((s, b), (0, 0))
            sums[s, b] = (n + 1, t + a)
    names = [P.DIRECT, P.ONE_BETWEEN, P.LINKED]
    want = {(s, b): (n, a, *sums.get((b, s), (0, 0)), names[min(far(s, b), 2)]) for (s, b), (n, a) in sums.items() if far(s, b) is not None}
    t = spark.createDataFrame(trade, "s string, b string, a int").repartition(3)
    p = spark.createDataFrame(parties, "party string, tax string, name string")
    for most in (0, 1, None):
        out = P.related_party_pairs(t, p, "s", "b", "a", "party", ["tax", "name"], max_between=most).collect()
        got = {(x.seller, x.buyer): (x.invoices, x.amount, x.reverse_invoices, x.reverse_amount, x.relation) for x in out}
        limit = 2 if most is None else most
        assert got == {k: v for k, v in want.items() if names.index(v[-1]) <= limit} and len(out) == len(got)
    assert P.related_party_pairs(t.limit(0), p.filter(F.lit(False)), "s", "b", "a", "party", ["tax"]).collect() == []


def test_stream_parses_a_workbook_once_and_takes_none_of_a_late_failure(spark, sf_small, monkeypatch):
    import io
    import zipfile

    from ledgerlens.sources import xlsx
    landing, base = local_scratch_dir(), local_scratch_dir()
    rows = bind_io.header_export(spark, sf_small)
    xlsx_writer.write_workbooks(rows.limit(300).repartition(1), landing, "发票基础信息").count()
    whole = xlsx_writer.workbook_bytes(rows.toPandas().iloc[[*range(1000)] * 6], "发票基础信息")
    with zipfile.ZipFile(io.BytesIO(whole)) as z, zipfile.ZipFile(f"{landing}/late.xlsx", "w") as out:
        for n in z.namelist():  # a cell of the last row names a text that is not there, after a full batch of rows
            tail = b'<row r="9999"><c r="A9999" t="s"><v>7</v></c></row></sheetData>'
            out.writestr(n, z.read(n).replace(b"</sheetData>", tail))
    asked, parse = [], xlsx.parse_files
    monkeypatch.setattr(xlsx, "parse_files", lambda f, t, m, whole=True: asked.append(whole) or parse(f, t, m, whole))
    got = stream(spark, landing, base, files=2)
    assert asked == [False]  # not read through beforehand
    assert [os.path.basename(r.file) for r in spark.read.parquet(f"{base}/side/errors").collect()] == ["late.xlsx"]
    assert {os.path.basename(r.source_file) for r in got.select("source_file").collect()} == {"part-00000.xlsx"}
