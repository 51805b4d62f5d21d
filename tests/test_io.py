"""Sources, sinks and the incremental import."""

import csv
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlens import sinks
from ledgerlens.operators.align import clean_name
from ledgerlens.operators.dedup import quarantine
from ledgerlens.plans import bind_io
from scratch import local_scratch_dir
from ledgerlens.sources import charset, files, xlsx, xlsx_writer


def test_workbook_roundtrip(spark, sf_small):
    src = bind_io._orders_as_text(spark, sf_small)
    rows = xlsx.read_workbooks(spark, bind_io._workbooks(spark, sf_small, parts=3))
    got = xlsx.sheet_table(rows, list(bind_io.ORDER_TITLES)).drop("file", "sheet", "row_no")
    assert got.count() == src.count()
    assert got.exceptAll(src).count() == 0 and src.exceptAll(got).count() == 0
    cat = xlsx.sheet_catalogue(rows).collect()
    assert len(cat) == 3 and all(r.sheet == "信息汇总表" and r.columns == list(bind_io.ORDER_TITLES) for r in cat)
    assert xlsx.title_union(rows) == sorted(bind_io.ORDER_TITLES)


def _styled_workbook(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/'
                   '2006/relationships"><sheets><sheet name="发票基础信息" sheetId="1" r:id="rId1"/>'
                   '<sheet name="空表" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml" Type="x"/>'
                   '<Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml" Type="x"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>发票号码</t></si><si><t>开票日期</t></si>'
                   '<si><r><t>金</t></r><r><t>额</t></r></si><si><t>001</t></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><numFmts count="1"><numFmt numFmtId="164" '
                   'formatCode="yyyy/mm/dd"/></numFmts><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="164"/>'
                   '<xf numFmtId="22"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData>'
                   '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>'
                   '<row r="2"><c r="A2" t="s"><v>3</v></c><c r="B2" s="1"><v>44197</v></c><c r="C2"><v>12.5</v></c></row>'
                   '<row r="3"><c r="A3" t="inlineStr"><is><t> </t></is></c></row>'
                   '<row r="5"><c r="B5" s="2"><v>44197.5</v></c><c r="C5" t="b"><v>1</v></c></row>'
                   '</sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {ns}><sheetData/></worksheet>')


def test_workbook_cells_dates_and_errors(spark):
    d = local_scratch_dir()
    _styled_workbook(os.path.join(d, "a.xlsx"))
    with open(os.path.join(d, "broken.xlsx"), "wb") as f:
        f.write(b"not a zip")
    with open(os.path.join(d, "~$a.xlsx"), "wb") as f:
        f.write(b"lock")
    rows = xlsx.read_workbooks(spark, d)
    data = sorted((r.row_no, r["values"]) for r in xlsx.data_rows(rows).collect())
    assert data == [(2, {"发票号码": "001", "开票日期": "2021-01-01", "金额": "12.5"}),
                    (5, {"发票号码": None, "开票日期": "2021-01-01 12:00:00", "金额": "TRUE"})]
    errors = rows.filter(F.col("error").isNotNull()).collect()
    assert len(errors) == 1 and errors[0].file.endswith("broken.xlsx")
    log = xlsx.error_rows(rows).collect()
    assert len(log) == 1 and log[0].stage == "read" and log[0].error_type == "BadZipFile"
    # the size limit keeps a file from being read at all, and says so
    small = xlsx.error_rows(xlsx.read_workbooks(spark, d, max_mb=0.0000001)).collect()
    assert {r.error_type for r in small} == {"FileTooLarge"} and len(small) == 2


def _one_sheet(path, rows_xml, encoding="utf-8"):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/'
                   '2006/relationships"><sheets><sheet name=" 信息 汇总表" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml" Type="x"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{rows_xml}</sheetData></worksheet>")


def test_characters_across_block_edges(monkeypatch, spark):
    d = local_scratch_dir()
    text = "".join(f'<row r="{i}"><c r="A{i}" t="inlineStr"><is><t>办公用品{i}</t></is></c></row>' for i in range(4, 40))
    path = os.path.join(d, "a.xlsx")
    _one_sheet(path, '<row r="3"><c r="A3" t="inlineStr"><is><t>货物 名称　</t></is></c></row>' + text)
    data = open(path, "rb").read()
    for chunk in (1, 2, 3, 5, 7, 64):  # some block edge lies inside every character
        monkeypatch.setattr(xlsx, "_CHUNK", chunk)
        rows = list(xlsx.iter_workbook_rows("a.xlsx", data))
        assert rows[0][4] == ["货物名称"] and rows[0][1] == "信息汇总表" and rows[0][3] == 3
        assert [r[5]["货物名称"] for r in rows[1:]] == [f"办公用品{i}" for i in range(4, 40)]


def test_a_file_is_read_whole_or_not_at_all(spark):
    d = local_scratch_dir()
    good = "".join(f'<row r="{i}"><c r="A{i}"><v>{i}</v></c></row>' for i in range(1, 6000))
    _one_sheet(os.path.join(d, "late.xlsx"), good + '<row r="6000"><c r="A6000" t="s"><v>7</v></c></row>')
    with open(os.path.join(d, "old.xls"), "wb") as f:
        f.write(b"x")
    for rows in (xlsx.read_workbooks(spark, d), xlsx.stage_workbooks(spark, d, local_scratch_dir() + "/raw")):
        assert xlsx.data_rows(rows).count() == 0 and xlsx.sheet_catalogue(rows).count() == 0
        assert sorted(r.error_type for r in xlsx.error_rows(rows).collect()) == ["IndexError", "UnsupportedFormat"]


def test_file_admission(spark):
    d = local_scratch_dir()
    for name, size in [("a.xlsx", 10), ("~$a.xlsx", 1), ("b.csv", 1), ("c.XLSM", 2 * 1024 * 1024)]:
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"x" * size)
    got = {r.name: (r.accepted, r.reason) for r in files.admitted_files(spark, d, max_mb=1).collect()}
    assert got["a.xlsx"] == (True, "ok")
    assert got["~$a.xlsx"] == (False, "temporary excel lock file")
    assert got["b.csv"] == (False, "unsupported extension")
    assert got["c.XLSM"][0] is False and got["c.XLSM"][1].startswith("file too large (2.0MB > 1")


def test_charset_csv(spark):
    d = local_scratch_dir()
    text = "发票代码,发票号码,金额,税额,说明\n1100,001,100.5,13.07,办公用品\n1100,002,20,2.6,差旅\n"
    for name, enc in [("u.csv", "utf-8"), ("bom.csv", "utf-8-sig"), ("g.csv", "gbk"), ("g2.csv", "gb2312")]:
        with open(os.path.join(d, name), "wb") as f:
            f.write(text.encode(enc))
    prof = {os.path.basename(r.path): r.charset for r in charset.charset_profile(spark, d).collect()}
    assert prof == {"u.csv": "UTF-8", "bom.csv": "UTF-8", "g.csv": "GB18030", "g2.csv": "GB18030"}
    df = charset.read_csv_any_charset(spark, d)
    assert set(df.columns) >= {"发票代码", "发票号码", "金额", "税额", "说明"}
    assert sorted(r["说明"] for r in df.collect()) == sorted(["办公用品", "差旅"] * 4)
    assert {r["发票号码"] for r in df.collect()} == {"001", "002"}


def test_charset_of_the_whole_content_and_own_headers(spark):
    d = local_scratch_dir()
    body = "x,1\n" * 4000
    with open(os.path.join(d, "a.csv"), "wb") as f:  # the first Chinese character stands far behind the start
        f.write(("code,amount\n" + body + "办公,2\n").encode("gbk"))
    with open(os.path.join(d, "b.csv"), "wb") as f:
        f.write(("amount, code \n" + "3,办公用品\n" * 4001).encode("utf-8"))
    got = charset.read_csv_any_charset(spark, d)
    counts = {(r.charset, r.code, r.amount): r["count"] for r in got.groupBy("charset", "code", "amount").count().collect()}
    assert counts == {("GB18030", "x", "1"): 4000, ("GB18030", "办公", "2"): 1, ("UTF-8", "办公用品", "3"): 4001}


def _csv_by_hand(content, encoding):
    records = list(csv.reader(io.TextIOWrapper(io.BytesIO(content), encoding, newline="")))
    return [tuple(c or None for c in (r + [""] * 9)[:3]) for r in records[1:] if r]


@pytest.mark.parametrize("chunk,part", [(1, 700), (400, 1 << 20)])
def test_csv_files_are_cut_at_any_byte(spark, monkeypatch, chunk, part):
    """Quoted line ends, doubled and stray quotes, letters whose bytes look like others, cut into ranges and chunks."""
    monkeypatch.setattr(charset, "CHUNK_BYTES", chunk)
    rng = random.Random(chunk)
    cells = ["x", "", "办公，用品", '"办\n公"', '"a ""b"", c"', 'st"ray', '"\r\n\n,"', "镕㐀", '"" "', '"q"tail"', '"""\n"""']
    d = local_scratch_dir()
    want = []
    for name, enc in [("u.csv", "utf-8"), ("b.csv", "utf-8-sig"), ("g.csv", "gb18030"), ("one.csv", "gb18030")]:
        n = 1 if name == "one.csv" else 80
        body = "".join(",".join(rng.choice(cells) for _ in range(3)) + rng.choice(["\n", "\r\n"]) for _ in range(n))
        content = ('"编 号",b,c\r\n' + body + "末,尾,办\n").encode(enc)
        with open(os.path.join(d, name), "wb") as f:
            f.write(content)
        want += [(name, "GB18030" if enc == "gb18030" else "UTF-8", *r) for r in _csv_by_hand(content, enc)]
    open(os.path.join(d, "empty.csv"), "wb").close()
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(part))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        title = charset.csv_titles(spark, d)
        df = charset.read_csv_any_charset(spark, d)
        got = [(os.path.basename(r.source_file), r.charset, r[clean_name("编 号")], r.b, r.c) for r in df.collect()]
        prof = {os.path.basename(r.path): (r.charset, r.has_bom) for r in charset.charset_profile(spark, d).collect()}
    finally:
        for c in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{c}")
    assert title == sorted(["b", "c", clean_name("编 号")])
    assert sorted(got, key=str) == sorted(want, key=str)
    assert prof == {"u.csv": ("UTF-8", False), "b.csv": ("UTF-8", True), "g.csv": ("GB18030", False),
                    "one.csv": ("GB18030", False)}


def test_stored_delete_of_a_whole_year(spark):
    path = local_scratch_dir() + "/t"
    sinks.write_partitioned(spark.createDataFrame([(1, 2020), (2, 2020), (3, 2021), (4, 2021)], "id int, invoice_year int"), path)
    left = sinks.delete_stored(spark, path, F.col("id") <= 3)
    assert [(r.id, r.invoice_year) for r in left.collect()] == [(4, 2021)]


def test_checkpoint_folder_must_be_set_off_local_masters():
    import pytest
    from ledgerlens import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_money_keeps_all_digits(spark):
    from ledgerlens import functions as L
    row = spark.createDataFrame([("1234567890123456.78",), ("1,234.5%",), ("abc",)], "x string").select(L.to_money("x").alias("m"))
    assert [str(r.m) for r in row.collect()] == ["1234567890123456.78", "1234.50", "None"]


def test_reports_on_empty_tables(spark):
    from ledgerlens.operators import summary
    empty = spark.createDataFrame([], "invoice_year int")
    counts = summary.table_rowcounts({"header": empty, "detail": empty}, by="invoice_year").collect()
    assert [(r.table_name, r.invoice_year, r.row_count, r.has_data) for r in counts] == [
        ("header", None, 0, False), ("detail", None, 0, False)]
    report = summary.quality_report(empty, empty, "invoice_year").collect()
    assert len(report) == 1 and report[0].is_total and report[0].issue_level == "ERROR"


def test_ties_mark_all_but_one(spark):
    from ledgerlens.operators.dedup import mark_uuid_duplicates
    df = spark.createDataFrame([(1, 5, None)] * 3 + [(2, 5, None)], "k int, t int, clean_status string")
    out = mark_uuid_duplicates(df, "k", ["t"], "dup")
    assert sorted((r.k, r.clean_status or "") for r in out.collect()) == [(1, ""), (1, "dup"), (1, "dup"), (2, "")]


def test_overwrite_years_replaces_only_touched_years(spark, sf_small):
    out = bind_io.overwrite_years(spark, sf_small)
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    want = o.filter((F.year("o_orderdate") != 1997) | (F.col("o_orderstatus") == "F")).count()
    assert out.count() == want


def test_incremental_import_does_not_depend_on_batch_size(spark, sf_small):
    one = bind_io.incremental_import(spark, sf_small, max_files_per_trigger=1)
    all_at_once = bind_io.incremental_import(spark, sf_small, max_files_per_trigger=1000)
    assert one.count() == all_at_once.count() > 0
    assert one.exceptAll(all_at_once).count() == 0


def test_streaming_reimport_is_idempotent(spark, sf_small):
    from ledgerlens.streaming.incremental import start_incremental_import
    base = local_scratch_dir()
    li = (spark.read.parquet(f"{sf_small}/lineitem.parquet")
          .select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate")
          .withColumn("invoice_year", F.year("l_shipdate")))
    li.write.parquet(f"{base}/landing/drop_1")
    args = (f"{base}/landing", bind_io.LANDING_SCHEMA, f"{base}/t", f"{base}/q", f"{base}/c",
            ["l_orderkey", "l_linenumber"])
    start_incremental_import(spark, *args).awaitTermination()
    first = spark.read.parquet(f"{base}/t").count()
    li.write.parquet(f"{base}/landing/drop_2")          # the same lines delivered again
    start_incremental_import(spark, *args).awaitTermination()
    assert spark.read.parquet(f"{base}/t").count() == first
    again = spark.read.parquet(f"{base}/q").filter("import_epoch = 1")
    assert again.count() == li.count()


def test_describe_and_sample(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    desc = {r.col_name: r for r in sinks.describe_table(li).collect()}
    assert desc["l_orderkey"].data_type == "bigint" and desc["l_shipdate"].data_type == "timestamp_ntz"
    assert desc["l_orderkey"].rows == li.count() and desc["l_orderkey"].nulls == 0
    assert [r.o_orderkey for r in sinks.table_sample(spark.read.parquet(f"{sf_small}/orders.parquet"),
                                                     "o_orderkey", 3).collect()] == [0, 1, 2]


def test_xlsx_writer_bytes_readable(spark):
    import pandas as pd
    data = xlsx_writer.workbook_bytes(pd.DataFrame({"a": ["1", None], "b": ["x<y", "z"]}), "S")
    rows = list(xlsx.iter_workbook_rows("m.xlsx", data))
    assert rows[0][4] == ["a", "b"]
    assert rows[1][5] == {"a": "1", "b": "x<y"} and rows[2][5] == {"a": None, "b": "z"}


def test_workbook_import_equals_direct_operators(spark, sf_small):
    from ledgerlens import functions as L
    from ledgerlens import ingest
    from ledgerlens.operators.dedup import quarantine
    from ledgerlens.operators.filters import valid_invoice_keys
    from ledgerlens.schemas import HEADER_TITLE_MAP
    d = local_scratch_dir()
    src = bind_io.header_export(spark, sf_small)
    xlsx_writer.write_workbooks(src.repartition(3), f"{d}/wb", "发票基础信息").count()
    res = ingest.import_headers(spark, f"{d}/wb", "b1", "2024-01-01 00:00:00", ledger=f"{d}/ledger")
    # same chain straight on the table-derived frame (blank cells are absent in the workbook)
    from ledgerlens.operators.align import clean_column_names
    src = clean_column_names(src)
    direct = src.select(*[F.when(~L.is_blank(F.col(t)), F.col(t)).alias(c) for t, c in HEADER_TITLE_MAP.items()
                          if t in src.columns])
    ok, bad = valid_invoice_keys(direct, "fpdm", "fphm", "sdfphm")
    ok = ok.withColumn("header_uuid", L.header_uuid(L.clean_identifier("fpdm"), L.clean_identifier("fphm"),
                                                    L.clean_identifier("sdfphm")))
    acc, _ = quarantine(ok, "header_uuid")
    want = acc.filter(F.coalesce(L.date_part("kprq"), L.parse_invoice_date("kprq")).isNotNull()).select("header_uuid")
    got = res.accepted.select("header_uuid")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    assert res.rejected_keys.count() == bad.count()
    # importing the same workbooks again: every key is already in the ledger
    again = ingest.import_headers(spark, f"{d}/wb", "b2", "2024-01-02 00:00:00", ledger=f"{d}/ledger")
    assert again.accepted.count() == 0
    assert spark.read.parquet(f"{d}/ledger").count() == got.count()


def test_detail_import_invariants(spark, sf_small):
    from ledgerlens import ingest
    d = local_scratch_dir()
    src = bind_io.detail_export(spark, sf_small)
    xlsx_writer.write_workbooks(src.repartition(3), f"{d}/wb", "信息汇总表").count()
    res = ingest.import_details(spark, f"{d}/wb", "b1", "2024-01-01 00:00:00", ledger=f"{d}/ledger")
    acc = res.accepted
    total = src.count()
    assert acc.count() + res.quarantined.count() + res.rejected_keys.count() + res.missing_year.count() == total
    assert acc.select("detail_uuid").distinct().count() == acc.count()
    # line numbers run 1..n per (file, sheet, invoice) in row order, before quarantine
    lines = acc.unionByName(res.quarantined.drop("quarantine_reason"), allowMissingColumns=True)
    chk = lines.groupBy("source_file", "source_sheet", "header_uuid").agg(
        F.count(F.lit(1)).alias("n"), F.max("logic_line_no").alias("mx"), F.min("logic_line_no").alias("mn"))
    assert chk.filter((F.col("mn") != 1) | (F.col("mx") != F.col("n"))).count() == 0
    # unit prices are cut, never rounded, to 8 decimals
    row = acc.filter(F.col("dj").isNotNull()).select("dj").first()
    assert row.dj.as_tuple().exponent == -8
    again = ingest.import_details(spark, f"{d}/wb", "b2", "2024-01-02 00:00:00", ledger=f"{d}/ledger")
    assert again.accepted.count() == 0


def test_error_log_export(spark):
    d = local_scratch_dir()
    errs = spark.createDataFrame([("a.xlsx", "S1", "read", "ValueError", "bad"),
                                  ("b.xlsx", None, "scan", "Weird", "permission denied")],
                                 "file string, sheet string, stage string, error_type string, message string")
    sinks.write_error_log(errs, f"{d}/errors")
    csv = spark.read.option("header", True).csv(f"{d}/errors/csv")
    js = spark.read.json(f"{d}/errors/json")
    assert csv.count() == js.count() == 2
    got = {r.file: (r.suggestion, r.category) for r in js.collect()}
    assert got["a.xlsx"][0].startswith("数据格式错误") and got["b.xlsx"][0].startswith("检查该文件")


def test_split_known_keys_normalized(spark):
    from ledgerlens.operators.joins import split_known_keys
    df = spark.createDataFrame([(" AB ",), ("cd",), ("ef",)], "k string")
    known = spark.createDataFrame([("ab",), ("CD ",)], "k string")
    new, seen = split_known_keys(df, known, "k", normalize=True)
    assert [r.k for r in new.collect()] == ["ef"] and sorted(r.k for r in seen.collect()) == [" AB ", "cd"]
    new2, _ = split_known_keys(df, known, "k")
    assert new2.count() == 3


def test_create_table_then_append(spark):
    from ledgerlens.schemas import HEADER_SCHEMA
    d = local_scratch_dir()
    t = sinks.create_table(spark, HEADER_SCHEMA, f"{d}/header")
    assert t.count() == 0 and t.schema == HEADER_SCHEMA
    row = spark.createDataFrame([{"header_uuid": "x", "invoice_year": 2023}], HEADER_SCHEMA)
    sinks.write_partitioned(row, f"{d}/header", mode="append")
    sinks.create_table(spark, HEADER_SCHEMA, f"{d}/header")          # exists: kept
    again = spark.read.schema(HEADER_SCHEMA).parquet(f"{d}/header")
    assert [(r.header_uuid, r.invoice_year) for r in again.collect()] == [("x", 2023)]


def test_ledger_from_workbooks(spark, sf_small):
    from ledgerlens import ingest
    d = local_scratch_dir()
    src = bind_io.detail_export(spark, sf_small)
    # deliver a slice of the lines twice, in a second file: exact copies must be dropped
    again = src.limit(50)
    xlsx_writer.write_workbooks(src.repartition(2), f"{d}/wb", "信息汇总表").count()
    xlsx_writer.write_workbooks(again.coalesce(1), f"{d}/wb2", "信息汇总表").count()
    import shutil  # copy the second delivery beside the first (test fixture layout only)
    shutil.copy(f"{d}/wb2/part-00000.xlsx", f"{d}/wb/again.xlsx")
    res = ingest.build_ledger_from_workbooks(spark, f"{d}/wb", f"{d}/ledger", "2024-01-01 00:00:00")
    n = src.count()
    assert res.ledger.count() + res.duplicates.count() == n + 50
    assert res.duplicates.count() >= 50
    m = res.metrics.agg(F.sum("rows_before").alias("b"), F.sum("rows_dropped").alias("x")).first()
    assert m.b == n + 50 and m.x == res.duplicates.count()
    assert set(res.ledger.columns) >= {"开票日期", "金额", "税率", "税率_数值", "invoice_year"}
    assert res.anomalies.count() >= 0 and res.cast_stats.count() > 0
    man = res.manifest.collect()
    assert len(man) == 3 and all(r.classification == "summary" and r.target_table == "detail" for r in man)


def test_import_with_tolerant_key_check(spark, sf_small):
    """Keys that differ in case only: new for the exact check, known for the tolerant one."""
    import os
    from ledgerlens import ingest
    from ledgerlens.sources import xlsx_writer
    src, ledger = os.path.join(local_scratch_dir(), "x"), os.path.join(local_scratch_dir(), "ledger")
    rows = bind_io.header_export(spark, sf_small).limit(60)
    xlsx_writer.write_workbooks(rows.repartition(2), src, "发票基础信息").count()
    first = ingest.import_headers(spark, src, "b1", "2024-01-01 00:00:00", ledger=ledger, mode="keep_first").accepted.count()
    upper = os.path.join(local_scratch_dir(), "upper")
    stored = spark.read.parquet(ledger).withColumn("header_uuid", F.upper("header_uuid"))
    stored.write.partitionBy("invoice_year").parquet(upper)
    again = ingest.import_headers(spark, src, "b2", "2024-01-02 00:00:00", ledger=upper, mode="keep_first", tolerant=True)
    assert first > 0 and again.accepted.count() == 0
    assert ingest.import_headers(spark, src, "b3", "2024-01-03 00:00:00", ledger=upper, mode="keep_first").accepted.count() == first


def test_stored_ledgers_are_flagged_once_and_as_run_dq_flags_them(spark, monkeypatch):
    """The stored pass (hot keys split, few missing keys broadcast, stages) against the plain one."""
    from ledgerlens import ingest, sinks
    from ledgerlens.operators import dedup, quality
    header = spark.createDataFrame(
        [(None if i == 7 else f"h{i % 30}", i % 5, None, "未校验", None, 3, 2024) for i in range(40)],
        "header_uuid string, created_at int, clean_status string, is_balanced string, balance_tolerance decimal(18,2), jshj int, invoice_year int")
    detail = spark.createDataFrame(
        [(None if i % 50 == 9 else f"h{1 if i < 120 else i % 33}", f"d{0 if i < 60 else i % 150}", i, None, 1, 2023 + i % 2) for i in range(300)],
        "header_uuid string, detail_uuid string, nth int, clean_status string, jshj int, invoice_year int")
    header = header.withColumn("row_no", F.monotonically_increasing_id())
    kinds = dict(header_order=["created_at", "row_no"], detail_order=["nth"])
    base = local_scratch_dir()
    sinks.write_partitioned(header, f"{base}/h")
    sinks.write_partitioned(detail, f"{base}/d")
    h, d = spark.read.parquet(f"{base}/h").cache(), spark.read.parquet(f"{base}/d").cache()
    text = lambda df: sorted(str(sorted(r.asDict().items())) for r in df.collect())
    want = [text(x) for x in quality.run_dq(h, d, checked_at="2024-01-01 00:00:00", checked_by="t", **kinds)]
    assert sum("明细缺失" in x for x in want[0]) > 0 and sum("主表缺失" in x for x in want[1]) > 0
    for hot, few in ((3, 0), (50, 1 << 20)):
        monkeypatch.setattr(dedup, "HOT_ROWS", hot)
        monkeypatch.setattr(quality, "FEW_KEYS", few)
        sinks.write_partitioned(h, f"{base}/h{hot}")
        sinks.write_partitioned(d, f"{base}/d{hot}")
        flagged, mark = [], dedup.group_flags
        monkeypatch.setattr(dedup, "group_flags", lambda *a: flagged.append(a[-1]) or mark(*a))
        got = ingest.check_quality(spark, f"{base}/h{hot}", f"{base}/d{hot}", "2024-01-01 00:00:00", "t", **kinds)
        assert [text(x) for x in got] == want and flagged == [True, True]
        monkeypatch.setattr(dedup, "group_flags", mark)
