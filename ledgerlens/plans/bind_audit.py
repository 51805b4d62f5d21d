"""Audit side outputs, sheet catalogue, key filters and schema alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.errors import SUGGESTIONS
from ledgerlens.functions.parse import parse_invoice_date
from ledgerlens.operators import align as AL
from ledgerlens.operators import audit as AU
from ledgerlens.operators import dedup as D
from ledgerlens.operators import filters as FL
from ledgerlens.operators import sheets as SH
from ledgerlens.plans.bind_scalars import (
    RAW_CODE, RAW_DATE_TEXT, RAW_ENO, RAW_NUMBER, RAW_NUMERIC, RAW_RATE, _DUCK_WS, _duck_num, _duck_parse_date,
)
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import table
from ledgerlens.schemas import DETAIL_TITLE_MAP, HEADER_STANDARD_ORDER, HEADER_TITLE_MAP

STAMP = "2024-01-01 00:00:00"

# ---- sheet rows derived from lineitem: dates, amounts and rates as raw text --

_L_DATE = RAW_DATE_TEXT.replace("o_orderdate", "l_shipdate").replace("o_orderkey", "l_orderkey")
_L_AMOUNT = (RAW_NUMERIC.replace("o_orderkey", "l_orderkey").replace("o_totalprice", "l_extendedprice")
             .replace("o_custkey", "l_partkey"))
_SHEET_COLS = {
    "file": "'batch_' || CAST(year(l_shipdate) AS STRING)",
    "sheet": "l_returnflag || l_linestatus",
    "row_index": "l_orderkey * 10 + l_linenumber",
    "发票号码": "lpad(CAST(l_orderkey AS STRING), 8, '0')",
    "开票日期": _L_DATE,
    "金额": _L_AMOUNT,
    "税率": RAW_RATE,
}
SPECS = {"开票日期": AU.DATE, "金额": AU.NUMERIC, "税率": AU.TAX_RATE}


def _sheet_rows(spark, d):
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_tax",
               "l_shipdate", "l_returnflag", "l_linestatus")
    return li.select(*[F.expr(e).alias(n) for n, e in _SHEET_COLS.items()])


_SHEET_SQL = "sheet AS (SELECT " + ", ".join(f'{e.replace("AS STRING", "AS VARCHAR")} AS "{n}"'
                                            for n, e in _SHEET_COLS.items()) + " FROM lineitem)"
_D_DATE = _duck_parse_date(f'trim("开票日期", {_DUCK_WS})')
_D_NUM = _duck_num("trim(replace(replace(replace(\"金额\", ',', ''), '，', ''), '%', ''))")
_D_RATE_S = "trim(replace(replace(regexp_replace(trim(COALESCE(\"税率\", '')), '%+$', ''), ',', ''), '％', ''))"
_D_TOKEN = "trim(COALESCE(\"税率\", '')) IN ('免税', '不征税', '免征')"
_D_RATE_NUM = _duck_num(_D_RATE_S)


def _blank(c):
    return f'({c} IS NULL OR trim({c}, {_DUCK_WS}) = \'\')'


_PARSED_SQL = f"""{_SHEET_SQL},
p AS (SELECT *, {_D_DATE} AS d_date, {_D_NUM} AS d_num, {_D_RATE_NUM} AS d_rate, {_D_TOKEN} AS d_tok FROM sheet)"""

_FAILURES_SQL = f"""{_PARSED_SQL},
fails AS (
  SELECT file, sheet, '开票日期' AS "column", row_index, "开票日期" AS orig_value, "发票号码" FROM p
  WHERE NOT {_blank('"开票日期"')} AND d_date IS NULL
  UNION ALL
  SELECT file, sheet, '金额', row_index, "金额", "发票号码" FROM p WHERE NOT {_blank('"金额"')} AND d_num IS NULL
  UNION ALL
  SELECT file, sheet, '税率', row_index, "税率", "发票号码" FROM p
  WHERE NOT {_blank('"税率"')} AND d_rate IS NULL AND NOT d_tok)"""


@bound("cast_failures", f"""
WITH {_FAILURES_SQL}
SELECT * FROM fails
""")
def cast_failures(spark, d):
    return AU.cast_failures(_sheet_rows(spark, d), SPECS, keys=["发票号码"])


@bound("failure_samples_topn", f"""
WITH {_FAILURES_SQL}
SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY file, sheet, row_index, orig_value) AS rank FROM fails
QUALIFY rank <= 3
""")
def failure_samples_topn(spark, d):
    fails = AU.cast_failures(_sheet_rows(spark, d), SPECS, keys=["发票号码"])
    return D.top_n_per_group(fails, "column", ["file", "sheet", "row_index", "orig_value"], 3)


@bound("cast_stats", f"""
WITH {_PARSED_SQL},
g AS (SELECT file, sheet, COUNT(*) AS t,
             COUNT(*) FILTER (WHERE d_date IS NOT NULL) AS c_date,
             COUNT(*) FILTER (WHERE d_num IS NOT NULL) AS c_num,
             COUNT(*) FILTER (WHERE d_rate IS NOT NULL) AS c_rate,
             COUNT(*) FILTER (WHERE d_rate IS NULL AND NOT d_tok AND NOT {_blank('"税率"')}) AS f_rate,
             COUNT(*) FILTER (WHERE d_tok) AS tok
      FROM p GROUP BY file, sheet)
SELECT file, sheet, '开票日期' AS "column", 'date_parse' AS method, t AS total, c_date AS converted, t - c_date AS failed FROM g
UNION ALL SELECT file, sheet, '金额', 'numeric_parse', t, c_num, t - c_num FROM g
UNION ALL SELECT file, sheet, '税率_数值', 'tax_parse', t, c_rate, f_rate FROM g
UNION ALL SELECT file, sheet, '税率_数值', 'map_tax_text_to_zero', t, tok, 0 FROM g WHERE tok > 0
UNION ALL SELECT file, sheet, '税率', 'tax_text_tokens', t, tok, t - tok - c_rate FROM g WHERE tok > 0
""")
def cast_stats(spark, d):
    return AU.cast_stats(_sheet_rows(spark, d), SPECS)


@bound("cast_typed", f"""
WITH {_PARSED_SQL}
SELECT file, sheet, row_index, d_date AS "开票日期", d_num AS "金额", "税率",
       CASE WHEN d_tok THEN 0.0 ELSE d_rate END AS "税率_数值" FROM p
""")
def cast_typed(spark, d):
    typed = AU.typed_frame(_sheet_rows(spark, d), SPECS)
    return typed.select("file", "sheet", "row_index", "开票日期", "金额", "税率", "税率_数值")


# ---- error log from events -------------------------------------------------

_ERR_TYPES = list(SUGGESTIONS) + ["RuntimeError"]
_ERR_TYPE = ("CASE " + " ".join(f"WHEN event_id % 13 = {i} THEN '{t}'" for i, t in enumerate(_ERR_TYPES))
             + " ELSE NULL END")
_ERR_MSG = ("event_type || CASE event_id % 7 WHEN 0 THEN ' permission denied' WHEN 1 THEN ' not found' "
            "WHEN 2 THEN ' corrupt file' WHEN 3 THEN ' file lock' WHEN 4 THEN ' xlsx broken' "
            "WHEN 5 THEN ' SQL error' ELSE '' END")
_LEVEL = ("CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'CRITICAL' "
          "WHEN 'click' THEN 'WARNING' ELSE 'INFO' END")


def _errors(spark, d):
    ev = table(spark, d, "events", "event_id", "event_type")
    return ev.select("event_id", F.expr(_ERR_TYPE).alias("error_type"), F.expr(_ERR_MSG).alias("message"),
                     F.expr(_LEVEL).alias("level"))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_D_SUGGEST = ("CASE WHEN error_type IS NULL OR error_type = '' THEN '' "
              + " ".join(f"WHEN error_type = {_q(k)} THEN {_q(v)}" for k, v in SUGGESTIONS.items())
              + f" WHEN contains(lower(message), 'permission') THEN {_q(SUGGESTIONS['PermissionError'])}"
              + f" WHEN contains(lower(message), 'not found') THEN {_q(SUGGESTIONS['FileNotFoundError'])}"
              + " WHEN contains(lower(message), 'invalid file') OR contains(lower(message), 'corrupt') THEN "
              + _q(SUGGESTIONS["InvalidFileException"])
              + " WHEN contains(lower(message), 'lock') OR contains(lower(message), 'access denied') THEN "
              + _q(SUGGESTIONS["FileLockedException"]) + " ELSE '' END")
_D_CATEGORY = ("CASE WHEN error_type = 'FileNotFoundError' THEN 'FILE_NOT_FOUND' "
               "WHEN error_type = 'PermissionError' THEN 'PERMISSION' WHEN error_type = 'MemoryError' THEN 'MEMORY_ERROR' "
               "WHEN contains(lower(message), 'xlsx') OR contains(lower(message), 'openpyxl') THEN 'EXCEL_PARSE' "
               "WHEN contains(lower(message), 'database') OR contains(lower(message), 'sql') THEN 'DB_QUERY' "
               "ELSE 'UNKNOWN' END")
_ERR_SQL = f"errs AS (SELECT event_id, {_ERR_TYPE} AS error_type, {_ERR_MSG} AS message, {_LEVEL} AS level FROM events)"


@bound("error_suggestion", f"""
WITH {_ERR_SQL}
SELECT event_id, error_type, message, {_D_SUGGEST} AS suggestion FROM errs
""")
def error_suggestion(spark, d):
    return AU.enrich_errors(_errors(spark, d)).select("event_id", "error_type", "message", "suggestion")


@bound("error_category", f"""
WITH {_ERR_SQL}
SELECT event_id, error_type, message, {_D_CATEGORY} AS category FROM errs
""")
def error_category(spark, d):
    return AU.enrich_errors(_errors(spark, d)).select("event_id", "error_type", "message", "category")


@bound("error_stats", f"""
WITH {_ERR_SQL}, c AS (SELECT {_D_CATEGORY} AS category, level FROM errs)
SELECT category, level, COUNT(*) AS error_count, GROUPING(category, level) AS grouping_id
FROM c GROUP BY GROUPING SETS ((), (category), (level))
""")
def error_stats(spark, d):
    return AU.error_stats(AU.enrich_errors(_errors(spark, d)), "category", "level")


# ---- file status from documents --------------------------------------------

_FILE = "source || '/' || CAST(doc_id AS STRING) || '.xlsx'"
_STATUS = ("CASE WHEN n_chars < 50 THEN 'scan_failed' WHEN lang = 'de' AND n_chars % 7 = 0 THEN 'read_failed' "
           "ELSE 'processed' END")


def _files(spark, d):
    docs = table(spark, d, "documents", "doc_id", "source", "lang", "n_chars")
    return docs.select(F.expr(_FILE).alias("file"), F.expr(_STATUS).alias("status"))


@bound("import_summary", f"""
SELECT COUNT(*) AS total_files, COUNT(*) FILTER (WHERE s = 'processed') AS processed_files,
       COUNT(*) FILTER (WHERE s = 'scan_failed') AS scan_failed_files,
       COUNT(*) FILTER (WHERE s = 'read_failed') AS read_failed_files
FROM (SELECT {_STATUS} AS s FROM documents)
""")
def import_summary(spark, d):
    return AU.import_summary(_files(spark, d))


@bound("failed_files", f"""
SELECT file, status FROM (SELECT {_FILE.replace("AS STRING", "AS VARCHAR")} AS file, {_STATUS} AS status FROM documents)
WHERE status IN ('scan_failed', 'read_failed')
""")
def failed_files(spark, d):
    return AU.failed_files(_files(spark, d))


# ---- sheet catalogue derived from orders ------------------------------------

_SHEET_NAMES = ["信息汇总表", "发票基础信息", "发票基础表2", "销项明细", "进项发票明细表", "铁路电子客票",
                "建筑服务明细", "不动产租赁经营服务", "机动车销售统一发票", "货物运输服务", "过路过桥费"]
_SHEET_NAME = ("CASE o_orderkey % 12 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_SHEET_NAMES))
               + " ELSE 'Sheet' || CAST(o_orderkey % 5 AS STRING) END")
_WB = "'wb' || CAST(o_custkey % 200 AS STRING) || '.xlsx'"
_TITLES = ["序号"] + HEADER_STANDARD_ORDER
_S_COLS = ("concat(array('序号'), slice(array(" + ", ".join(f"'{t}'" for t in HEADER_STANDARD_ORDER)
           + "), 1, CAST(o_orderkey % 12 AS INT)))")
_D_COLS = ("list_concat(['序号'], list_slice([" + ", ".join(f"'{t}'" for t in HEADER_STANDARD_ORDER)
           + "], 1, CAST(o_orderkey % 12 AS INTEGER)))")


def _sheets(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey")
    return o.select(F.expr(_WB).alias("file"), F.expr(_SHEET_NAME).alias("sheet"),
                    (F.col("o_orderkey") % 12).alias("sheet_index"), F.expr(_S_COLS).alias("columns"))


def _dsql(s: str) -> str:
    return s.replace("AS STRING", "AS VARCHAR")


_D_CLASS = ("CASE " + " ".join(f"WHEN regexp_matches(sheet, '(?i){p}') THEN 'special:{k}'"
                               for p, k in SH.SPECIAL_SHEET_PATTERNS)
            + " WHEN regexp_matches(sheet, '(?i)信息汇总') THEN 'summary'"
            + " WHEN regexp_matches(sheet, '(?i)发票基础信息|发票基础(?:信息|表)?\\d*') THEN 'header'"
            + " WHEN regexp_matches(sheet, '(?i)发票基础信息|.*明细.*') THEN 'detail' ELSE 'ignored' END")
_SHEETS_SQL = (f"sh AS (SELECT {_dsql(_WB)} AS file, {_dsql(_SHEET_NAME)} AS sheet, o_orderkey % 12 AS sheet_index, "
               f"{_D_COLS} AS columns FROM orders)")


@bound("classify_sheets", f"""
WITH {_SHEETS_SQL}
SELECT DISTINCT file, sheet, {_D_CLASS} AS classification FROM sh
""")
def classify_sheets(spark, d):
    return SH.classify_sheets(_sheets(spark, d).select("file", "sheet").distinct(), "sheet")


_KNOWN = list(DETAIL_TITLE_MAP)


@bound("best_sheet_by_overlap", f"""
WITH {_SHEETS_SQL},
c AS (SELECT DISTINCT file, sheet, sheet_index,
             len(list_intersect(columns, [{", ".join(f"'{k}'" for k in _KNOWN)}])) AS overlap,
             starts_with(sheet, '信息汇总表') AS pref FROM sh)
SELECT file, sheet, overlap FROM c WHERE pref OR overlap >= 3
QUALIFY row_number() OVER (PARTITION BY file ORDER BY pref DESC, overlap DESC, sheet_index) = 1
""")
def best_sheet_by_overlap(spark, d):
    sheets = _sheets(spark, d).distinct()
    return SH.best_sheet_by_overlap(sheets, _KNOWN, 3)


@bound("sheet_manifest", f"""
WITH {_SHEETS_SQL}, c AS (SELECT *, {_D_CLASS} AS classification FROM sh)
SELECT file, sheet, classification, max(array_to_string(columns, ';')) AS columns,
       CASE WHEN classification LIKE 'special:%' THEN 'special_' || lower(substr(classification, 9, 64))
            WHEN classification = 'summary' THEN 'detail' WHEN classification = 'detail' THEN 'detail'
            WHEN classification = 'header' THEN 'header' END AS target_table,
       COUNT(*) AS "rows"
FROM c GROUP BY file, sheet, classification
""")
def sheet_manifest(spark, d):
    sheets = _sheets(spark, d)
    catalogue = SH.classify_sheets(sheets.select("file", "sheet", "columns").distinct(), "sheet")
    return SH.sheet_manifest(catalogue, sheets.select("file", "sheet"))


@bound("route_and_union", """
SELECT o_orderkey AS invoice_no, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, NULL::INTEGER AS line_no,
       NULL::VARCHAR AS remark, 'header' AS classification, 'header' AS target_table FROM orders
UNION ALL
SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)), l_linenumber, NULL, 'summary', 'detail' FROM lineitem
UNION ALL
SELECT o_orderkey, NULL, NULL, o_orderpriority, 'special:RAILWAY', 'special_railway' FROM orders WHERE o_orderkey % 12 = 5
""")
def route_and_union(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    li = table(spark, d, "lineitem", "l_orderkey", "l_extendedprice", "l_linenumber")
    h = o.select(F.col("o_orderkey").alias("invoice_no"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
                 F.lit("header").alias("classification"))
    dt = li.select(F.col("l_orderkey").alias("invoice_no"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
                   F.col("l_linenumber").alias("line_no"), F.lit("summary").alias("classification"))
    sp = o.filter(F.col("o_orderkey") % 12 == 5).select(
        F.col("o_orderkey").alias("invoice_no"), F.col("o_orderpriority").alias("remark"),
        F.lit("special:RAILWAY").alias("classification"))
    return SH.route_and_union([h, dt, sp])


# ---- key completeness, missing year ------------------------------------------

def _keys(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey")
    return o.select("o_orderkey", F.expr(RAW_CODE).alias("fpdm"), F.expr(RAW_NUMBER).alias("fphm"),
                    F.expr(RAW_ENO).alias("sdfphm"))


_D_HAS = {c: f"NOT {_blank(c)}" for c in ("fpdm", "fphm", "sdfphm")}
_KEYS_SQL = (f"k AS (SELECT o_orderkey, {_dsql(RAW_CODE)} AS fpdm, {_dsql(RAW_NUMBER)} AS fphm, "
             f"{_dsql(RAW_ENO)} AS sdfphm FROM orders),"
             f" r AS (SELECT *, CASE WHEN NOT ({_D_HAS['fpdm']}) AND NOT ({_D_HAS['fphm']}) AND NOT ({_D_HAS['sdfphm']})"
             f" THEN 'no_invoice_key' WHEN ({_D_HAS['fpdm']}) <> ({_D_HAS['fphm']}) AND NOT ({_D_HAS['sdfphm']})"
             f" THEN 'partial_paper_key' END AS reject_reason FROM k)")


@bound("valid_invoice_keys", f"""
WITH {_KEYS_SQL}
SELECT o_orderkey, fpdm, fphm, sdfphm FROM r WHERE reject_reason IS NULL
""")
def valid_invoice_keys(spark, d):
    ok, _ = FL.valid_invoice_keys(_keys(spark, d), "fpdm", "fphm", "sdfphm")
    return ok


@bound("rejected_invoice_keys", f"""
WITH {_KEYS_SQL}
SELECT * FROM r WHERE reject_reason IS NOT NULL
""")
def rejected_invoice_keys(spark, d):
    _, bad = FL.valid_invoice_keys(_keys(spark, d), "fpdm", "fphm", "sdfphm")
    return bad


@bound("missing_year_rejects", f"""
WITH r AS (SELECT o_orderkey, {RAW_DATE_TEXT} AS kprq FROM orders)
SELECT o_orderkey, kprq, NULL::INTEGER AS invoice_year, 'missing_year' AS reject_reason FROM r
WHERE year({_duck_parse_date(f"trim(kprq, {_DUCK_WS})")}) IS NULL
""")
def missing_year_rejects(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    o = o.select("o_orderkey", F.expr(RAW_DATE_TEXT).alias("kprq"))
    o = o.withColumn("invoice_year", F.year(parse_invoice_date("kprq")))
    _, bad = FL.split_missing_year(o, "invoice_year")
    return bad


# ---- schema alignment ---------------------------------------------------------

def _titled(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    return o.select(F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("发票号码"),
                    F.col("o_orderdate").cast("date").cast("string").alias("开票日期"),
                    F.col("o_totalprice").cast("string").alias("价税合计"),
                    F.col("o_orderpriority").alias("备注"),
                    F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("购买方名称"),
                    F.lit("x").alias("其他"))


_ALIGN_COLS = ["fpdm", "fphm", "sdfphm", "gfmc", "kprq", "jshj", "bz"]


@bound("align_schema", """
SELECT NULL::VARCHAR AS fpdm, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS fphm, NULL::VARCHAR AS sdfphm,
       'Customer ' || CAST(o_custkey AS VARCHAR) AS gfmc, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS kprq,
       CAST(o_totalprice AS VARCHAR) AS jshj, o_orderpriority AS bz
FROM orders
""")
def align_schema(spark, d):
    return AL.align_schema(_titled(spark, d), HEADER_TITLE_MAP, _ALIGN_COLS)


_BLANK_CELLS = {
    "c1": "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE o_orderpriority END",
    "c2": "CASE o_orderkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE o_orderstatus END",
    "c3": "CASE WHEN o_orderkey % 5 = 0 THEN '　' WHEN o_orderkey % 5 = 1 THEN NULL ELSE CAST(o_custkey AS STRING) END",
}


@bound("drop_blank_rows", f"""
WITH c AS (SELECT o_orderkey, {", ".join(f"{_dsql(e)} AS {n}" for n, e in _BLANK_CELLS.items())} FROM orders)
SELECT c1, c2, c3 FROM c
WHERE NOT ({_blank('c1')} AND {_blank('c2')} AND {_blank('c3')})
""")
def drop_blank_rows(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey")
    cells = o.select(*[F.expr(e).alias(n) for n, e in _BLANK_CELLS.items()])
    return AL.drop_blank_rows(cells)


@bound("clean_column_names", """
SELECT CAST(o_custkey AS VARCHAR) AS "发票代码", lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS "发票号码",
       o_orderpriority AS "备注" FROM orders
""")
def clean_column_names(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    raw = o.select(F.col("o_custkey").cast("string").alias(" 发票 代码 "),
                   F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("发票　号码"),
                   F.col("o_orderpriority").alias("备注 "))
    return AL.clean_column_names(raw)


@bound("reorder_columns", """
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS header_uuid, o_orderpriority AS "备注",
       CAST(o_totalprice AS VARCHAR) AS "价税合计", lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS "发票号码",
       o_orderstatus AS extra_status FROM orders
""")
def reorder_columns(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    raw = o.select(F.col("o_orderpriority").alias("备注"), F.col("o_orderstatus").alias("extra_status"),
                   F.col("o_totalprice").cast("string").alias("价税合计"),
                   F.md5(F.col("o_orderkey").cast("string")).alias("header_uuid"),
                   F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("发票号码"))
    return AL.reorder_columns(raw, HEADER_STANDARD_ORDER, ["header_uuid", "source_system", "created_at"])


@bound("schema_union", """
SELECT o_orderkey AS invoice_no, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, NULL::INTEGER AS line_no FROM orders
UNION ALL
SELECT l_orderkey, NULL, l_linenumber FROM lineitem
""")
def schema_union(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice").select(
        F.col("o_orderkey").alias("invoice_no"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber").select(
        F.col("l_orderkey").alias("invoice_no"), F.col("l_linenumber").alias("line_no"))
    return AL.schema_union([o, li])


@bound("audit_columns", f"""
SELECT o_orderkey, 'orders.parquet' AS source_file, TIMESTAMP '{STAMP}' AS import_ts FROM orders
""")
def audit_columns(spark, d):
    o = table(spark, d, "orders", "o_orderkey")
    return AL.audit_columns(o, STAMP).select("o_orderkey", "source_file", "import_ts")


_DEFAULT_IN = {
    "created_by": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'user' || CAST(o_orderkey % 5 AS STRING) END",
    "is_balanced": "CASE WHEN o_orderkey % 4 = 0 THEN '强制通过' END",
    "balance_tolerance": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(0.2 AS DECIMAL(18,2)) END",
}


@bound("default_fill", f"""
SELECT o_orderkey, COALESCE({_dsql(_DEFAULT_IN['created_by'])}, 'SYSTEM') AS created_by,
       COALESCE({_DEFAULT_IN['is_balanced']}, '未校验') AS is_balanced,
       COALESCE({_DEFAULT_IN['balance_tolerance']}, CAST(0.1 AS DECIMAL(18,2))) AS balance_tolerance,
       '金税导出' AS source_system
FROM orders
""")
def default_fill(spark, d):
    o = table(spark, d, "orders", "o_orderkey")
    o = o.select("o_orderkey", *[F.expr(e).alias(n) for n, e in _DEFAULT_IN.items()])
    return AL.default_fill(o, {"created_by": "SYSTEM", "is_balanced": "未校验",
                               "balance_tolerance": 0.1, "source_system": "金税导出"})


@bound("invoice_struct", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {RAW_RATE} AS raw FROM lineitem),
k AS (SELECT *, trim(COALESCE(raw, '')) IN ('免税', '不征税', '免征') AS tok,
             {_duck_num("trim(replace(replace(regexp_replace(trim(COALESCE(raw, '')), '%+$', ''), ',', ''), '％', ''))")} AS num
      FROM r)
SELECT l_orderkey, l_linenumber, l_orderkey AS invoice_no, l_linenumber AS line_no,
       COALESCE(CASE WHEN tok THEN 0.0 ELSE num END, TRY_CAST(raw AS DOUBLE)) AS tax_rate
FROM k
""")
def invoice_struct(spark, d):
    from ledgerlens.functions.parse import parse_tax_rate
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_tax").withColumn("raw", F.expr(RAW_RATE))
    li = li.withColumn("rate_num", parse_tax_rate("raw"))
    out = AL.invoice_struct(li, {"invoice_no": "l_orderkey", "line_no": "l_linenumber"}, "rate_num", "raw")
    return out.select("l_orderkey", "l_linenumber", "record.*")


@bound("error_log_export", f"""
WITH {_ERR_SQL}
SELECT f.log, event_id, error_type, message, level, nullif({_D_SUGGEST}, '') AS suggestion, {_D_CATEGORY} AS category
FROM errs, (VALUES ('csv'), ('json')) AS f(log)
""")
def error_log_export(spark, d):
    """Error rows written as CSV and JSON logs, both read back."""
    import uuid
    from ledgerlens import sinks
    from ledgerlens.session import scratch_path
    path = scratch_path(spark, f"error-log-{uuid.uuid4().hex[:12]}")
    sinks.write_error_log(_errors(spark, d), path)
    names = ["event_id", "error_type", "message", "level", "suggestion", "category"]
    js = spark.read.schema("event_id bigint, error_type string, message string, level string, "
                           "suggestion string, category string").json(f"{path}/json")
    text = spark.read.option("header", True).csv(f"{path}/csv")
    both = text.select(F.lit("csv").alias("log"), F.col("event_id").cast("bigint"), *names[1:]) \
        .union(js.select(F.lit("json"), *names))
    return both.withColumn("suggestion", F.nullif("suggestion", F.lit("")))
