"""Sheet pieces read whole against the reader that takes row by row; micro-batches that leave few files."""

import glob
import random

import pyarrow as pa
import pytest

from ledgerlens.plans import bind_io
from ledgerlens.sources import sheetscan, xlsx, xlsx_writer
from ledgerlens.streaming.workbooks import import_workbooks
from scratch import local_scratch_dir

SHARED = ["共享", "s1", " ", "x&y", ""]
TEXTS = ["a", "", "有限", "　", " ", "a&amp;b", "&#32;", "x>y", "&lt;row&gt;", "1.50", "45000", "12345.5", "\n", "é"]
ODD = ['<c r="A1" t="inlineStr"/>', '<c r="B1"></c>', "<c><v>3</v></c>", " ", '<c r="C2"><f>A1</f><v>3</v></c>', "</c>", "<t>", "</row>",
       '<c r="D1" t="inlineStr"><is><r><t>q</t></r></is></c>', '<c t="s" r="A1"><v>0</v></c>', '<row r="4">', '<c r="A9"', "<v>",
       "</v></c>", "</t></is></c>", '"', '<c r="A1" t="s"><v>99</v></c>', "<row>", '<row r="7"/>', "\x01", "<c r='A1'><v>1</v></c>",
       '<c r="AAAA1"><v>1</v></c>', '<c r="A1" s="1" ><v>2</v></c>', '<c r="A1" cm="1"><v>2</v></c>', "<v/>", "<!-- x -->"]


def _cell(r, ref):
    text, style = r.choice(TEXTS), r.choice(["", "", "", ' s="1"', ' s="2"'])
    return r.choice([f'<c r="{ref}"{style} t="inlineStr"><is><t>{text}</t></is></c>'] * 4 + [
        f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>',
        f'<c r="{ref}"{style}><v>{r.choice(["1", "45000", "3.25", ""])}</v></c>', f'<c r="{ref}" t="s"><v>{r.choice("01234")}</v></c>',
        f'<c r="{ref}" t="b"><v>{r.choice("01")}</v></c>', f'<c r="{ref}" t="{r.choice(["str", "e", "n"])}"><v>{text}</v></c>',
        f'<c r="{ref}"{style}/>'])


def _piece(r, odd: bool) -> str:
    out, n = [], r.randrange(1, 200)
    for _ in range(r.randrange(1, 8)):
        cells = [_cell(r, f"{xlsx_writer._col_letters(c)}{n}") for c in sorted(r.sample(range(30), r.randrange(0, 6)))]
        if odd and r.random() < .4:
            cells.insert(r.randrange(len(cells) + 1), r.choice(ODD))
        out.append(f'<row r="{n}"{r.choice(["", "", " spans=" + chr(34) + "1:3" + chr(34)])}>{"".join(cells)}</row>{r.choice(["", "", chr(10)])}')
        n += r.randrange(1, 4)
    text = "".join(out)
    return text[:text.rfind("</row>") + 6]


@pytest.mark.parametrize("wanted", [None, xlsx.IN_PLACE, ["a", "t3", "zz", "t1"]])
def test_pieces_read_whole_hold_the_rows_of_the_row_reader(wanted):
    r, whole = random.Random(5), 0

    def sheet():
        s = xlsx._Sheet("f", "s", 0, 1, wanted, SHARED, {1}, False)
        s._title_row({j: f"t{j % 9}" if j % 5 else "" for j in range(12)})
        return s

    for n in range(1500):
        text, s, plain = _piece(r, n % 2 == 1), sheet(), n % 2 == 0
        batch = s.batch(text.encode(), pa.array(SHARED, pa.string()))
        assert batch is not None or not plain, text
        if batch is None:
            continue
        batch.validate(full=True)
        whole += 1
        got = [tuple(row[c] for c in xlsx._ROW_COLUMNS) for row in batch.to_pylist(maps_as_pydicts="strict")]
        other = sheet()
        assert got == list(other.rows(text)) and s.next_row == other.next_row, text
    assert whole > 750


def test_a_workbook_is_read_by_pieces(monkeypatch):
    """Rows behind the titles come from ``scan``, for chunks of any size, and are those of the row reader."""
    import pandas as pd
    pdf = pd.DataFrame([(f"{i}", None if i % 3 else "有限&<", "") for i in range(500)], columns=["a", "b", "c"])
    data, scanned, scan = xlsx_writer.workbook_bytes(pdf, "s"), [], sheetscan.scan
    monkeypatch.setattr(sheetscan, "scan", lambda *a: scanned.append(scan(*a)) or scanned[-1])
    want = list(xlsx.iter_workbook_rows("f", data, wanted=["b", "x", "a"]))
    for chunk in (64, 1000, 1 << 20):
        monkeypatch.setattr(xlsx, "_CHUNK", chunk)
        del scanned[:]
        batches = list(xlsx.workbook_batches("f", data, wanted=["b", "x", "a"]))
        assert [tuple(row[c] for c in xlsx._ROW_COLUMNS) for b in batches for row in b.to_pylist(maps_as_pydicts="strict")] == want
        taken = sum(len(p.row_no) for p in scanned if p is not None)
        assert taken == 500, chunk


def test_a_micro_batch_leaves_few_files_and_settings_as_they_were(spark, sf_small):
    """The keys that later micro-batches look up lie in a file a year, not one a task and year."""
    landing, base = local_scratch_dir(), local_scratch_dir()
    xlsx_writer.write_workbooks(bind_io.header_export(spark, sf_small).repartition(2), landing, "发票基础信息").count()
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        import_workbooks(spark.read.format("binaryFile").load(landing), 0, "header", f"{base}/ledger", f"{base}/side", "s",
                         "2024-01-01 00:00:00")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    years = glob.glob(f"{base}/ledger/import_epoch=0/invoice_year=*")
    assert len(years) > 5 and all(len(glob.glob(f"{y}/*.parquet")) == 1 for y in years)
    assert {f.name for f in spark.read.parquet(f"{base}/ledger").schema} >= {"import_epoch", "invoice_year", "header_uuid"}


def test_rows_of_an_arrow_array_are_packed_as_they_lie():
    import io
    import zipfile
    rows = [f'<row r="{i}">有限{i}</row>' for i in range(2, 30)]
    whole, packed = pa.array(["<row/>", *rows, "<row/>"]), []
    for chunks in ([rows], [whole[1:5], whole[5:5], pa.array(rows[4:], pa.large_string())]):
        buf = io.BytesIO()
        assert xlsx_writer.write_rows(buf, chunks, ["a"], "s") == len(rows)
        packed.append(zipfile.ZipFile(buf).read("xl/worksheets/sheet1.xml"))
    assert packed[0] == packed[1]


def test_line_numbers_sort_by_a_hash_and_import_stages_compile(spark, monkeypatch):
    """The sort before the line numbers begins with a number, whatever the files' names share; stage tables are
    written with methods that the JVM compiles, in any session, and its setting stays."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from ledgerlens import ingest
    from ledgerlens.operators.dedup import logic_line_no
    r = random.Random(2)
    rows = [(r.choice(["file:/a/1", "file:/a/2", None]), r.choice(["s", "t"]), r.choice(["x", "y", None]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "source_file string, source_sheet string, k string, row_no int").repartition(3)
    out = logic_line_no(df, "k", ["source_file", "source_sheet", "row_no"])
    w = Window.partitionBy("source_file", "source_sheet", "k").orderBy("row_no")
    want = df.withColumn("logic_line_no", F.row_number().over(w))
    assert out.columns == want.columns and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "windowspecdefinition(__part" in plan
    name, seen, lower = "spark.sql.codegen.hugeMethodLimit", [], ingest.compilable_methods
    before = spark.conf.get(name)
    spark.conf.set(name, "65535")
    monkeypatch.setattr(ingest, "compilable_methods", lambda s: seen.append(True) or lower(s))
    try:
        assert ingest._stage(spark, df, "t").count() == 300 and seen == [True]
        with lower(spark):
            assert spark.conf.get(name) == "8000"
        assert spark.conf.get(name) == "65535"
    finally:
        spark.conf.set(name, before)


def test_cells_in_place_are_those_of_the_titles(spark, monkeypatch):
    """The ledger build stores no map per row; titles are found once per sheet, the last of a repeated one."""
    import pandas as pd

    from ledgerlens import ingest
    folder = local_scratch_dir()
    frames = [pd.DataFrame([["1", "x", None, "9"], [None, None, "q", None]], columns=["发票代码", "金额", "", "发票代码"]),
              pd.DataFrame([["7", "2024-01-02"]], columns=["金额", "开票日期"])]
    for i, pdf in enumerate(frames):
        with open(f"{folder}/{i}.xlsx", "wb") as f:
            head = xlsx_writer.write_rows(f, [[xlsx_writer._row_xml(n, row) for n, row in enumerate(pdf.itertuples(index=False), 2)]],
                                          list(pdf.columns), "信息汇总表")
            assert head == len(pdf)
    titles = ["开票日期", "发票代码", "金额", "没有"]
    want = xlsx.sheet_table(xlsx.read_workbooks(spark, folder), titles)
    rows = xlsx.read_workbooks(spark, folder, titles=xlsx.IN_PLACE)
    got = xlsx.in_place_table(rows, xlsx.sheet_catalogue(rows), titles)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r["发票代码"] for r in got.collect()} == {"9", None}
    asked, stage = [], xlsx.stage_workbooks
    monkeypatch.setattr(xlsx, "stage_workbooks", lambda *a, **k: asked.append(k["titles"]) or stage(*a, **k))
    out = ingest.build_ledger_from_workbooks(spark, folder, local_scratch_dir(), "2024-01-01 00:00:00")
    assert asked == [xlsx.IN_PLACE] and out.ledger.count() == 1 and out.missing_year.count() == 2
    assert sorted((r.columns, r.rows) for r in out.manifest.collect()) == [("发票代码;金额;;发票代码", 2), ("金额;开票日期", 1)]


def test_stage_tables_are_read_in_small_tasks(spark, monkeypatch):
    """What a stage table is written from is cut into tasks of ``TASK_BYTES`` at most; a session's own setting,
    whatever its form, comes back, and a smaller one stays."""
    from ledgerlens import ingest, session
    name = "spark.sql.files.maxPartitionBytes"
    before, entered, small = spark.conf.get(name), [], ingest.small_scans
    try:
        for own, inside in (("128MB", str(session.TASK_BYTES)), ("134217728b", str(session.TASK_BYTES)), ("1m", "1m")):
            spark.conf.set(name, own)
            with small(spark):
                assert spark.conf.get(name).removesuffix("b") == inside
            assert spark.conf.get(name) == own
    finally:
        spark.conf.set(name, before)
    monkeypatch.setattr(ingest, "small_scans", lambda s: entered.append(True) or small(s))
    assert ingest._stage(spark, spark.range(5).toDF("n"), "t").count() == 5 and entered == [True]
