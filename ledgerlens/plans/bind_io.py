"""Sources, sinks and streaming bound to the driver tables.

Workbooks, CSV exports and landing drops are derived from the tables by
Spark jobs and written under the session's checkpoint folder (a fresh
sub-folder per call), then read back through the library's sources.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens import ingest, routing, sinks
from ledgerlens.keyindex import KeyIndex
from ledgerlens.plans.bind_scalars import RAW_CODE, RAW_ENO, RAW_NUMBER, RAW_REMARK
from ledgerlens.plans.bind_scalars import _duck_key as duck_key
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import table
from ledgerlens.schemas import INVOICE_DATE
from ledgerlens.session import scratch_path
from ledgerlens.operators import dedup, sheets
from ledgerlens.sources import charset, xlsx, xlsx_writer
from ledgerlens.streaming.incremental import start_incremental_import
from ledgerlens.streaming.workbooks import start_workbook_import

# spreadsheet titles for the orders columns written to workbooks
ORDER_TITLES = {"发票号码": "o_orderkey", "购买方名称": "o_custkey", "发票状态": "o_orderstatus",
                "价税合计": "o_totalprice", "开票日期": "o_orderdate", "备注": "o_orderpriority"}


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _orders_as_text(spark, d):
    o = table(spark, d, "orders", *ORDER_TITLES.values())
    return o.select(*[(F.col(c).cast("date") if c == "o_orderdate" else F.col(c)).cast("string").alias(t)
                      for t, c in ORDER_TITLES.items()])


# rows of one workbook: some MB, far below the admission limit and the format's rows of a sheet
WORKBOOK_ROWS = 50_000


def _parts(rows) -> int:
    """Number of workbooks that hold the rows: it grows with them."""
    return max(4, -(-rows.count() // WORKBOOK_ROWS))


def _workbooks(spark, d, parts: int | None = None):
    out = _scratch(spark, "workbooks")
    src = _orders_as_text(spark, d)
    src = src.repartition(parts or _parts(src), "发票号码")
    xlsx_writer.write_workbooks(src, out, "信息汇总表").count()
    return out


_ORDER_TEXTS = ", ".join(f'CAST({"CAST(" + c + " AS DATE)" if c == "o_orderdate" else c} AS VARCHAR) AS "{t}"'
                         for t, c in ORDER_TITLES.items())


@bound("xlsx_scan", f"SELECT '信息汇总表' AS sheet, {_ORDER_TEXTS} FROM orders")
def xlsx_scan(spark, d):
    rows = xlsx.read_workbooks(spark, _workbooks(spark, d))
    return xlsx.sheet_table(rows, list(ORDER_TITLES)).drop("file", "row_no")


@bound("sheet_columns", f"""
SELECT '信息汇总表' AS sheet, '{";".join(ORDER_TITLES)}' AS columns, COUNT(*) AS data_rows FROM orders
""")
def sheet_columns(spark, d):
    """Titles of the sheets, with the rows that stand under them."""
    rows = xlsx.read_workbooks(spark, _workbooks(spark, d))
    heads = xlsx.sheet_catalogue(rows).select("file", "sheet", F.array_join("columns", ";").alias("columns"))
    return (xlsx.data_rows(rows).select("file", "sheet").join(heads, ["file", "sheet"])
            .groupBy("sheet", "columns").agg(F.count(F.lit(1)).alias("data_rows")))


@bound("charset_profile", f"""
SELECT *, 'UTF-8' AS charset FROM (SELECT {_ORDER_TEXTS} FROM orders)
UNION ALL SELECT *, 'GB18030' FROM (SELECT {_ORDER_TEXTS.replace("o_orderpriority", "'备注 ' || o_orderpriority")} FROM orders)
""")
def charset_profile(spark, d):
    """The orders as CSV in two character sets and two column orders."""
    out = _scratch(spark, "csv")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    src = _orders_as_text(spark, d)
    src.write.option("header", True).option("encoding", "UTF-8").csv(out + "/utf8")
    gbk = src.withColumn("备注", F.concat(F.lit("备注 "), "备注"))
    gbk.select(*reversed(gbk.columns)).write.option("header", True).option("encoding", "GBK").csv(out + "/gbk")
    return charset.read_csv_any_charset(spark, out).drop("source_file")


# a listing as long as the table: names and sizes made from documents
_FILE_NAME = """CASE WHEN doc_id % 7 = 0 THEN '~$' ELSE '' END || CAST(doc_id AS STRING) || CASE doc_id % 4
  WHEN 0 THEN '.xlsx' WHEN 1 THEN '.XLSM' WHEN 2 THEN '.csv' ELSE '.xls' END"""


@bound("file_admission", f"""
WITH f AS (SELECT {_FILE_NAME} AS name, n_chars * 99991 AS length FROM documents),
r AS (SELECT *, CASE WHEN starts_with(name, '~$') THEN 'temporary excel lock file'
    WHEN NOT regexp_matches(lower(name), '\\.(xls|xlsx|xlsm)$') THEN 'unsupported extension'
    WHEN length / 1048576.0 > 500 THEN printf('file too large (%.1fMB > 500.0MB limit)', (length / 1048576.0)::DOUBLE)
    ELSE 'ok' END AS reason FROM f)
SELECT name, length, reason, reason = 'ok' AS accepted FROM r
""")
def file_admission(spark, d):
    listed = table(spark, d, "documents", "doc_id", "n_chars").select(
        F.expr(_FILE_NAME).alias("name"), (F.col("n_chars") * 99991).alias("length"))
    return sheets.file_admission(listed, "name", "length", 500.0)


@bound("overwrite_years", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS invoice_year
FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderstatus = 'F'
""")
def overwrite_years(spark, d):
    path = _scratch(spark, "ledger")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    sinks.write_partitioned(o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                     F.year("o_orderdate").alias("invoice_year")), path)
    current = spark.read.parquet(path)
    fresh = current.filter((F.col("invoice_year") == 1997) & (F.col("o_orderstatus") == "F"))
    sinks.overwrite_same_table(spark, fresh, path)
    return spark.read.parquet(path)


@bound("layer_promote", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, 'dwd' AS layer FROM orders
""")
def layer_promote(spark, d):
    src = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return sinks.promote(spark, src, _scratch(spark, "dwd"), lambda df: df.withColumn("layer", F.lit("dwd")))


@bound("table_sample", """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 100
""")
def table_sample(spark, d):
    return sinks.table_sample(table(spark, d, "orders"), "o_orderkey", 100)


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@bound("describe_table", " UNION ALL ".join(
    f"""SELECT '{c}' AS col_name, COUNT(*) AS "rows", COUNT(*) - COUNT({c}) AS nulls FROM lineitem""" for c in _LINE_COLUMNS))
def describe_table(spark, d):
    return sinks.describe_table(table(spark, d, "lineitem", *_LINE_COLUMNS)).select("col_name", "rows", "nulls")


@bound("delete_stored", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS invoice_year FROM orders
WHERE year(o_orderdate) <> 1997 AND o_orderstatus <> 'P'
""")
def delete_stored(spark, d):
    """A stored delete of one whole year and of some rows of every other."""
    path = _scratch(spark, "delete")
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    sinks.write_partitioned(o.select("o_orderkey", "o_orderstatus", "o_totalprice",
                                     F.year("o_orderdate").alias("invoice_year")), path)
    left = sinks.delete_stored(spark, path, (F.col("invoice_year") == 1997) | (F.col("o_orderstatus") == "P"))
    return left.select("o_orderkey", "o_totalprice", "invoice_year")


LANDING_SCHEMA = ("l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_extendedprice double, "
                  "l_shipdate timestamp_ntz, invoice_year int")


LINE_KEY = ["l_orderkey", "l_linenumber"]


@bound("incremental_import", """
WITH l AS (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS invoice_year FROM (
    SELECT l_orderkey, l_linenumber % 3 AS l_linenumber, l_suppkey, l_extendedprice, l_shipdate FROM lineitem)),
n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        CASE WHEN invoice_year <= 1996 THEN 1 WHEN invoice_year <= 1998 THEN 2 ELSE 3 END,
        l_shipdate, l_suppkey, l_extendedprice) AS k FROM l)
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate, invoice_year FROM n WHERE k = 1
""")
def incremental_import(spark, d, max_files_per_trigger: int | None = 1000):
    """Three landing drops (lines by ship year; of one key, lines may stand
    in all of them), imported in two stream runs; the target holds the first
    line of every key. A drop is as many files as Spark makes of it; a key's
    lines stand in one of them, so their order is that of the order columns."""
    base = _scratch(spark, "incremental")
    landing, target, held, ckpt = (f"{base}/landing", f"{base}/target", f"{base}/quarantine", f"{base}/_ckpt")
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate")
    li = li.withColumns({"l_linenumber": F.col("l_linenumber") % 3, "invoice_year": F.year("l_shipdate")})
    drops = [F.col("invoice_year") <= 1996, F.col("invoice_year").between(1997, 1998), F.col("invoice_year") >= 1999]

    def run():
        start_incremental_import(spark, landing, LANDING_SCHEMA, target, held, ckpt, LINE_KEY,
                                 max_files_per_trigger=max_files_per_trigger,
                                 order=["l_shipdate", "l_suppkey", "l_extendedprice"]).awaitTermination()

    li.filter(drops[0]).repartition(*LINE_KEY).write.parquet(f"{landing}/drop_1")
    run()
    for i, cond in enumerate(drops[1:], start=2):
        li.filter(cond).repartition(*LINE_KEY).write.parquet(f"{landing}/drop_{i}")
    run()
    return spark.read.parquet(target).drop("import_epoch")


# header export: titles with blanks, invoice keys with blanks and repeats,
# dates in several layouts, amounts beyond a double's digits, remarks
HEADER_EXPORT = {
    "发票 代码": RAW_CODE, "发票　号码": RAW_NUMBER, "数电发票号码": RAW_ENO,
    "开票日期": """CASE o_orderkey % 4 WHEN 0 THEN CAST(datediff(CAST(o_orderdate AS DATE), DATE'1899-12-30') AS STRING)
      WHEN 1 THEN date_format(o_orderdate, 'yyyyMMdd') WHEN 2 THEN date_format(o_orderdate, 'yyyy.M.d')
      ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:11' END""",
    "金额": "CASE WHEN o_orderkey % 50 = 9 THEN '1,234,567,890,123,456.78' ELSE CAST(o_totalprice AS STRING) END",
    "税额": "CAST(ROUND(o_totalprice * 0.13, 2) AS STRING)",
    "价税合计": "CAST(ROUND(o_totalprice * 1.13, 2) AS STRING)",
    "购买方名称": "'Customer#' || CAST(o_custkey AS STRING)", "备注": RAW_REMARK,
}


def header_export(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return o.select(*[F.expr(e).alias(t) for t, e in HEADER_EXPORT.items()])


def _duck_clean(c: str) -> str:
    return f"""nullif(trim({c}, ' 　'), '')"""


_HEADER_IMPORT = f"""
WITH r AS (SELECT o_orderdate, o_totalprice, o_orderkey, {_duck_clean(f"({RAW_CODE})")} AS code,
                  {_duck_clean(f"({RAW_NUMBER})")} AS num, {_duck_clean(f"({RAW_ENO})")} AS eno FROM orders),
k AS (SELECT *, md5({duck_key('code', 'num', 'eno')}) AS header_uuid FROM r
      WHERE eno IS NOT NULL OR (code IS NOT NULL AND num IS NOT NULL)),
n AS (SELECT *, COUNT(*) OVER (PARTITION BY header_uuid) AS copies FROM k)
SELECT header_uuid, CAST(o_orderdate AS DATE) AS invoice_date, CAST(year(o_orderdate) AS INTEGER) AS invoice_year,
       CASE WHEN o_orderkey % 50 = 9 THEN CAST('1234567890123456.78' AS DECIMAL(18,2))
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS je
FROM n WHERE copies = 1
"""


@bound("workbook_import", _HEADER_IMPORT)
def workbook_import(spark, d):
    """Header workbooks written from orders, imported into a fresh ledger."""
    src = _scratch(spark, "header-export")
    rows = header_export(spark, d)
    xlsx_writer.write_workbooks(rows.repartition(_parts(rows)), src, "发票基础信息").count()
    res = ingest.import_headers(spark, src, "batch-1", "2024-01-01 00:00:00", ledger=_scratch(spark, "header-ledger"))
    return res.accepted.select("header_uuid", "invoice_date", "invoice_year", "je")


@bound("workbook_reimport", "SELECT 0 AS accepted_again, COUNT(*) AS held_again FROM (" + _HEADER_IMPORT + ")")
def workbook_reimport(spark, d):
    """The same workbooks imported twice: the second time nothing is accepted."""
    src, ledger = _scratch(spark, "header-export"), _scratch(spark, "header-ledger")
    rows = header_export(spark, d)
    xlsx_writer.write_workbooks(rows.repartition(_parts(rows)), src, " 发票基础信息").count()
    ingest.import_headers(spark, src, "batch-1", "2024-01-01 00:00:00", ledger=ledger)
    again = ingest.import_headers(spark, src, "batch-2", "2024-01-02 00:00:00", ledger=ledger)
    held = again.quarantined.groupBy("header_uuid").count().filter("count = 1")
    return held.agg(F.count(F.lit(1)).alias("held_again")).join(
        again.accepted.agg(F.count(F.lit(1)).cast("int").alias("accepted_again")), how="cross")


# detail export: lines of lineitem, with long Chinese texts and unit prices with long fractions
DETAIL_EXPORT = {
    "发票代码": "'0' || lpad(CAST(l_orderkey % 97 AS STRING), 11, '0')",
    "发票号码": "lpad(CAST(l_orderkey AS STRING), 8, '0')",
    "数电发票号码": "CASE WHEN l_orderkey % 7 = 0 THEN '2' || lpad(CAST(l_orderkey AS STRING), 19, '0') END",
    "开票日期": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "货物或应税劳务名称": "repeat('货物或应税劳务，', 12) || CAST(l_partkey AS STRING)",
    "数量": "CAST(l_quantity AS STRING)",
    "单价": "CAST(l_extendedprice / l_quantity AS STRING)",
    "金额": "CAST(l_extendedprice AS STRING)",
    "税率": "CAST(CAST(ROUND(l_tax * 100) AS INT) AS STRING) || '%'",
    "税额": "CAST(ROUND(l_extendedprice * l_tax, 2) AS STRING)",
    "价税合计": "CAST(ROUND(l_extendedprice * (1 + l_tax), 2) AS STRING)",
}
_LINE_PLACE = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax"]


def detail_export(spark, d, parts: int | None = None, twice: str | None = None):
    """The export's rows, the lines of an order in one partition and in
    order; lines that meet ``twice`` stand in it twice."""
    li = table(spark, d, "lineitem", *_LINE_PLACE)
    if twice:
        li = li.union(li.filter(twice))
    return (li.repartition(parts or _parts(li), "l_orderkey").sortWithinPartitions(*_LINE_PLACE)
            .select(*[F.expr(e).alias(t) for t, e in DETAIL_EXPORT.items()]))


def _duck(t: str) -> str:
    return DETAIL_EXPORT[t]


@bound("detail_workbook_import", f"""
WITH l AS (SELECT *, coalesce({_duck("数电发票号码")}, {_duck("发票代码")} || {_duck("发票号码")}) AS inv,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_LINE_PLACE)}) AS line FROM lineitem)
SELECT md5(inv) AS header_uuid, md5(inv || line) AS detail_uuid, CAST(line AS INTEGER) AS logic_line_no,
       CAST(l_shipdate AS DATE) AS invoice_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS je,
       CAST(year(l_shipdate) AS INTEGER) AS invoice_year
FROM l
""")
def detail_workbook_import(spark, d):
    """Detail workbooks ('信息汇总表') written from lineitem, imported into a fresh ledger."""
    src = _scratch(spark, "detail-export")
    xlsx_writer.write_workbooks(detail_export(spark, d), src, "信息汇总表").count()
    res = ingest.import_details(spark, src, "batch-1", "2024-01-01 00:00:00", ledger=_scratch(spark, "detail-ledger"))
    return res.accepted.select("header_uuid", "detail_uuid", "logic_line_no", "invoice_date", "je", "invoice_year")


_LEDGER_TITLES = ["发票代码", "发票号码", "数电发票号码", "货物或应税劳务名称"]


@bound("workbook_ledger", f"""
SELECT {", ".join(f'{_duck(t).replace("STRING", "VARCHAR")} AS "{t}"' for t in _LEDGER_TITLES)},
       CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CAST(l_shipdate AS DATE) AS invoice_day, CAST(year(l_shipdate) AS INTEGER) AS invoice_year
FROM (SELECT DISTINCT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_tax, CAST(l_shipdate AS DATE) AS l_shipdate
      FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_quantity, l_extendedprice,
                                         CAST(l_shipdate AS DATE), ROUND(l_extendedprice * l_tax, 2)
                                         ORDER BY l_tax) AS k FROM lineitem) WHERE k = 1)
""")
def workbook_ledger(spark, d):
    """Detail workbooks written from lineitem, a tenth of the lines twice,
    cast, de-duplicated and written as the year-partitioned ledger (the
    ledger is returned)."""
    src = _scratch(spark, "ledger-export")
    xlsx_writer.write_workbooks(detail_export(spark, d, twice="l_orderkey % 10 = 3"), src, "信息汇总表").count()
    out = ingest.build_ledger_from_workbooks(spark, src, _scratch(spark, "ledger"), "2024-01-01 00:00:00").ledger
    return out.select(*_LEDGER_TITLES, F.col("数量").cast("decimal(18,2)").alias("quantity"),
                      F.col("金额").cast("decimal(18,2)").alias("amount"), F.col(INVOICE_DATE).alias("invoice_day"), "invoice_year")


@bound("header_workbook_ledger", f"""
SELECT {", ".join(f'CAST({e.replace("STRING", "VARCHAR")} AS VARCHAR) AS "{t}"' for t, e in
                  (("发票代码", RAW_CODE), ("发票号码", RAW_NUMBER), ("数电发票号码", RAW_ENO)))},
       CAST(o_orderdate AS DATE) AS invoice_day, CAST(year(o_orderdate) AS INTEGER) AS invoice_year
FROM (SELECT *, row_number() OVER (PARTITION BY {RAW_CODE.replace("STRING", "VARCHAR")},
          {RAW_NUMBER.replace("STRING", "VARCHAR")}, {RAW_ENO.replace("STRING", "VARCHAR")} ORDER BY o_orderkey) AS k FROM orders)
WHERE k = 1
""")
def header_workbook_ledger(spark, d):
    """The header ledger: orders written as header workbooks, in order within
    and across the files, de-duplicated on the three invoice numbers."""
    src = _scratch(spark, "header-ledger-export")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    place = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    o = o.repartitionByRange(_parts(o), *place).sortWithinPartitions(*place)
    rows = o.select(*[F.expr(e).alias(t) for t, e in HEADER_EXPORT.items()])
    xlsx_writer.write_workbooks(rows, src, "发票基础信息").count()
    out = ingest.build_ledger_from_workbooks(spark, src, _scratch(spark, "header-ledger"), "2024-01-01 00:00:00",
                                             kind="header").ledger
    return out.select("发票代码", "发票号码", "数电发票号码", F.col(INVOICE_DATE).alias("invoice_day"), "invoice_year")


@bound("duplicates_export", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day, CAST(year(l_shipdate) AS INTEGER) AS invoice_year
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS k
      FROM lineitem) WHERE k > 1
""")
def duplicates_export(spark, d):
    """Later copies of a line key exported as CSV by year and read back."""
    path = _scratch(spark, "duplicates")
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    li = li.withColumn("invoice_year", F.year("l_shipdate"))
    flagged = dedup.flag_duplicates(li, LINE_KEY, ["l_shipdate", "l_partkey", "l_suppkey"])
    copies = flagged.filter("is_duplicate").select(*LINE_KEY, F.to_date("l_shipdate").alias("ship_day"), "invoice_year")
    sinks.export_duplicates(copies, path)
    return spark.read.schema("l_orderkey bigint, l_linenumber int, ship_day date, invoice_year int") \
        .option("header", True).csv(path)


@bound("known_key_index", """
WITH ledger AS (SELECT 'K' || CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE o_orderkey % 3 <> 1),
batch AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN ' k' WHEN 1 THEN 'K' ELSE 'k' END || CAST(o_orderkey AS VARCHAR) AS k
          FROM orders WHERE o_orderkey % 5 < 2)
SELECT o_orderkey, k IN (SELECT k FROM ledger) AS known, lower(trim(k)) IN (SELECT lower(k) FROM ledger) AS known_tolerant
FROM batch
""")
def known_key_index(spark, d):
    """Keys of a batch that a stored ledger holds, exactly and after trimming
    and lower-casing, by the index beside the ledger. The ledger is written in
    two appends, the index refreshed in between."""
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    rows = o.filter("o_orderkey % 3 <> 1").select(F.expr("'K' || CAST(o_orderkey AS STRING)").alias("k"),
                                                  F.year("o_orderdate").alias("invoice_year"), "o_orderkey")
    path = _scratch(spark, "indexed-ledger")
    index = KeyIndex(spark, path, "k", expected_keys=1_000_000, buckets=16)
    for part in (0, 1):
        sinks.write_partitioned(rows.filter(F.col("o_orderkey") % 2 == part), path, mode="append")
        index.refresh()
    batch = o.filter("o_orderkey % 5 < 2").select("o_orderkey", F.expr(
        "CASE o_orderkey % 4 WHEN 0 THEN ' k' WHEN 1 THEN 'K' ELSE 'k' END || CAST(o_orderkey AS STRING)").alias("k"))
    exact, tolerant = index.known(batch), index.known(batch, tolerant=True)
    out = batch.join(exact.withColumn("e", F.lit(True)), "k", "left").join(tolerant.withColumn("t", F.lit(True)), "k", "left")
    no = F.lit(False)
    return out.select("o_orderkey", F.coalesce("e", no).alias("known"), F.coalesce("t", no).alias("known_tolerant"))


ROUTED = {
    "header": ["发票代码", "发票号码", "数电发票号码", "开票日期", "价税合计"],
    "detail": ["发票代码", "发票号码", "货物或应税劳务名称", "单价", "数量", "金额"],
    "special_railway": ["数电发票号码", "车次", "乘车日期", "出行人"],
    "special_toll": ["通行日期起", "车牌号", "发票号码"],
}
# sheet name, condition on orders, titles; values are texts of the order key
_SENT = [
    ("HEADER__2024", "o_orderkey % 6 = 0", ["发票代码", "发票号码", "备注"]),
    ("Sheet1", "o_orderkey % 6 = 1", ["发票号码", "单价", "数量", "金额", "别的"]),
    ("任意", "o_orderkey % 6 = 2", ["车次", "乘车日期", "数电发票号码"]),
    ("TOLL__1", "o_orderkey % 6 = 3", ["发票代码", "发票号码", "通行日期起", "价税合计"]),
    ("杂项", "o_orderkey % 6 = 4", ["备用一", "备用二"]),
    ("TEMP__x", "o_orderkey % 6 = 5", ["发票代码", "发票号码", "单价"]),
]
_ROUTES = [("header", "prefix", "发票号码"), ("detail", "overlap", "发票号码"), ("special_railway", "overlap", "数电发票号码"),
           ("special_toll", "prefix", "发票号码"), ("transit", "transit", "备用一"), ("transit", "prefix", "发票号码")]


@bound("routed_import", " UNION ALL ".join(
    f"SELECT '{target}' AS target_table, '{route}' AS route, 'v{titles.index(shown)}-' || o_orderkey AS value, "
    f"{len(titles) if target == 'transit' else sum(t in ROUTED[target] for t in titles)} AS filled FROM orders WHERE {where}"
    for (_, where, titles), (target, route, shown) in zip(_SENT, _ROUTES)))
def routed_import(spark, d):
    """Workbooks of six kinds of sheets routed to four tables and the transit
    table, by sheet prefix or by shared titles, and read back."""
    folder, path = _scratch(spark, "routed-export"), _scratch(spark, "routed")
    o = table(spark, d, "orders", "o_orderkey")
    for i, (sheet, where, titles) in enumerate(_SENT):
        rows = o.filter(where).select(*[F.concat(F.lit(f"v{j}-"), F.col("o_orderkey").cast("string")).alias(t)
                                        for j, t in enumerate(titles)])
        xlsx_writer.write_workbooks(rows.repartition(_parts(rows) // 4 or 1), f"{folder}/{i}", sheet).count()
    _, folders, _ = routing.import_routed(spark, folder, path, ROUTED, "batch-1", _scratch(spark, "routed-rows"))
    shown = {target: title for target, _, title in reversed(_ROUTES)}
    out = None
    for target, stored in folders.items():
        t = spark.read.parquet(stored)
        if target == routing.TRANSIT:
            value = F.coalesce(F.col("values").getItem("备用一"), F.col("values").getItem("发票号码"))
            filled = F.size(F.map_filter("values", lambda _, v: v.isNotNull()))
        else:
            value = F.col(shown[target])
            filled = sum((F.col(c).isNotNull().cast("int") for c in ROUTED[target]), F.lit(0))
        part = t.select(F.lit(target).alias("target_table"), "route", value.alias("value"), filled.cast("int").alias("filled"))
        out = part if out is None else out.union(part)
    return out


@bound("streaming_workbook_import", f"""
WITH r AS (SELECT o_orderdate, {_duck_clean(f"({RAW_CODE})")} AS code, {_duck_clean(f"({RAW_NUMBER})")} AS num,
                  {_duck_clean(f"({RAW_ENO})")} AS eno FROM orders)
SELECT DISTINCT md5({duck_key('code', 'num', 'eno')}) AS header_uuid FROM r
WHERE eno IS NOT NULL OR (code IS NOT NULL AND num IS NOT NULL)
""")
def streaming_workbook_import(spark, d, max_files_per_trigger: int = 2):
    """Header workbooks picked up by a stream in several micro-batches: one
    row of every key is accepted, as in one batch import."""
    landing, base = _scratch(spark, "landing-workbooks"), _scratch(spark, "streamed")
    rows = header_export(spark, d)
    xlsx_writer.write_workbooks(rows.repartition(_parts(rows)), landing, "发票基础信息").count()
    start_workbook_import(spark, landing, "header", f"{base}/ledger", f"{base}/side", f"{base}/checkpoint", "stream",
                          "2024-01-01 00:00:00", max_files_per_trigger=max_files_per_trigger).awaitTermination()
    return spark.read.parquet(f"{base}/ledger").select("header_uuid")
