"""Workbook queries stay whole when the rows outgrow one admitted file."""

import os
import sys

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from ledgerlens.plans import bind_io
from ledgerlens.plans.tables import TABLES
from ledgerlens.sources import xlsx, xlsx_writer
from scratch import local_scratch_dir

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


@pytest.mark.parametrize("name", ["header_workbook_ledger", "xlsx_scan", "sheet_columns", "workbook_import",
                                  "workbook_reimport", "detail_workbook_import", "workbook_ledger"])
def test_no_rows_lost_to_the_admission_limit(spark, sf_small, monkeypatch, name):
    from oracle_check import rows_of_duck, rows_of_spark
    read = xlsx.read_workbooks
    monkeypatch.setattr(bind_io, "WORKBOOK_ROWS", 50, raising=False)
    # a fourth of the orders makes a workbook above this limit, 50 rows do not
    monkeypatch.setattr(xlsx, "read_workbooks", lambda *a, **k: read(*a, **{**k, "max_mb": 0.015}))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    got = rows_of_spark(queries()[name](spark, sf_small))
    assert got == rows_of_duck(con.sql(oracle_sql()[name]))


def test_part_names_sort_as_the_partitions_do():
    parts = [0, 9, 10, 99_999, 100_000, 999_999, 1_000_000, 12_345_678]
    names = [xlsx_writer._part_name(p) for p in parts]
    assert names == sorted(names) and names[0] == "part-00000.xlsx"


def test_import_shuffles_no_sheet_row_for_its_files_or_repeats(spark, sf_small):
    """Failed files and chosen sheets are broadcast however large Spark takes them for;
    repeated keys given as such part the batch as grouping its rows does."""
    from ledgerlens import ingest
    from ledgerlens.operators.dedup import quarantine, repeated_keys
    folder = local_scratch_dir()
    xlsx_writer.write_workbooks(bind_io.detail_export(spark, sf_small, parts=2), folder, "信息汇总表").count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = ingest._rows(spark, folder, "b", list(ingest.DETAIL_TITLE_MAP))
        chosen = xlsx.sheet_catalogue(rows).select("file", "sheet")
        plan = ingest._chosen_rows(rows, chosen, ingest.DETAIL_TITLE_MAP)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("c", 6)], "k string, n int")
    known = spark.createDataFrame([("c",)], "k string")
    repeats = repeated_keys(df.filter("k is not null"), "k").select("k")
    out = [[sorted(tuple(r) for r in f.select("n", *f.columns[2:]).collect()) for f in quarantine(df, "k", known, repeats=x)]
           for x in (repeats, None)]
    assert out[0] == out[1] == [[(3,), (4,), (5,)], [(1, "repeated_in_batch"), (2, "repeated_in_batch"), (6, "already_imported")]]


def test_rows_written_by_spark_are_those_of_the_row_writer(spark):
    import zipfile

    import pandas as pd
    rows = [("a&b<c>d", None, "有限 ' \""), (None, None, None), ("", "&amp;", "x\ny")] * 7
    df = spark.createDataFrame(rows, "a string, `b.c` string, d string").coalesce(1)
    folder, cols = local_scratch_dir(), df.columns
    assert [r.rows for r in xlsx_writer.write_workbooks(df, folder, "s").collect()] == [21]
    with zipfile.ZipFile(f"{folder}/part-00000.xlsx") as z:
        got = z.read("xl/worksheets/sheet1.xml").decode()
    want = "".join(xlsx_writer._row_xml(i, r) for i, r in enumerate([cols, *rows], 1))
    assert got == xlsx_writer._SHEET_HEAD + want + xlsx_writer._SHEET_TAIL
    assert len(xlsx_writer.workbook_bytes(pd.DataFrame(rows, columns=cols), "s")) > 500
    asked, row = [], xlsx_writer._row_xml
    xlsx_writer._row_xml = lambda i, r: asked.append(i) or row(i, r)
    try:  # in this process: only the titles are made by Python, the rows come as they are
        xlsx_writer.write_rows(os.path.join(folder, "x.xlsx"), [["<row/>"]], cols, "s")
    finally:
        xlsx_writer._row_xml = row
    assert asked == [1]


def test_ledger_build_shuffles_no_sheet_row_for_its_sheets(spark, sf_small, monkeypatch):
    """However large Spark takes the chosen sheets for, they are broadcast, and rows of cold keys meet once."""
    from ledgerlens import ingest
    from ledgerlens.operators import dedup
    folder, plans, stage = local_scratch_dir(), {}, ingest._stage
    xlsx_writer.write_workbooks(bind_io.detail_export(spark, sf_small, parts=2, twice="l_orderkey % 10 = 3"), folder, "信息汇总表").count()

    def seen(spark, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(spark, df, name)

    monkeypatch.setattr(ingest, "_stage", seen)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = []
        for hot in (100_000, 2):  # all keys cold, and repeated ones hot
            monkeypatch.setattr(dedup, "HOT_ROWS", hot)
            out = ingest.build_ledger_from_workbooks(spark, folder, local_scratch_dir(), "2024-01-01 00:00:00")
            kept.append(sorted(str(r) for r in out.ledger.drop("file", "sheet", "row_index").collect()))
        assert kept[0] == kept[1] and len(kept[0]) == len(set(kept[0]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plans["parsed"] and "BroadcastHashJoin" in plans["parsed"]


def test_rows_by_pieces_are_those_of_the_pattern():
    import random
    r = random.Random(3)
    parts = ['<row r="1"><c r="A1"/></row>', "<row><c/>\n</row>", '<row r="2"/>', '<row r="3" />', "<row></row>", "</sheetData>",
             '<row\n r="4">x</row>', "<rowBreaks a='1'/>", '<sheetData>', ' ', '<x:row r="5"><x:c/></x:row>', "&lt;row&gt;"]
    for n in range(400):
        text = "".join(r.choice(parts[:None if n % 4 == 0 else 10]) for _ in range(r.randrange(0, 9)))
        assert list(xlsx._rows_of(text)) == [m.groups() for m in xlsx._ROW.finditer(text)], text
