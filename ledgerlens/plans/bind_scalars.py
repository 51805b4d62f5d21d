"""Scalar parsers and keys, applied to dirty text derived from table keys.

Each query builds raw spreadsheet-like text from the driver tables with a
SQL fragment that Spark and DuckDB both accept (so the input is identical
on both sides), then parses it with the library function. The oracle SQL
re-implements the parse in DuckDB's dialect.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import functions as L
from ledgerlens.functions import keys
from ledgerlens.functions.parse import is_tax_free_token
from ledgerlens.plans.registry import bound
from ledgerlens.plans.tables import table

# -- raw text fragments (valid in Spark SQL and DuckDB) ----------------------

RAW_NUMERIC = """CASE o_orderkey % 9
  WHEN 0 THEN CAST(o_totalprice AS STRING)
  WHEN 1 THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || ',' ||
              lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0') || '.5'
  WHEN 2 THEN '  ' || CAST(o_custkey AS STRING) || ' '
  WHEN 3 THEN 'n/a'
  WHEN 4 THEN ''
  WHEN 5 THEN CAST(o_custkey AS STRING) || '%'
  WHEN 6 THEN CAST(o_custkey AS STRING) || 'd'
  WHEN 7 THEN '-' || CAST(o_custkey AS STRING) || 'e2'
  ELSE NULL END"""

RAW_RATE = """CASE (l_orderkey + l_linenumber) % 12
  WHEN 0 THEN CAST(CAST(ROUND(l_tax * 100) AS INT) AS STRING) || '%'
  WHEN 1 THEN CAST(CAST(ROUND(l_tax * 100) AS INT) AS STRING)
  WHEN 2 THEN '免税'
  WHEN 3 THEN '不征税'
  WHEN 4 THEN ' 免征 '
  WHEN 5 THEN CAST(l_tax AS STRING)
  WHEN 6 THEN 'abc'
  WHEN 7 THEN NULL
  WHEN 8 THEN ''
  WHEN 9 THEN CAST(CAST(ROUND(l_tax * 100) AS INT) AS STRING) || '％'
  WHEN 10 THEN CAST(CAST(ROUND(l_tax * 100) AS INT) AS STRING) || '%%'
  ELSE '1,3' END"""

_Y = "CAST(year(o_orderdate) AS STRING)"
_M = "CAST(month(o_orderdate) AS STRING)"
_D = "CAST(day(o_orderdate) AS STRING)"
_HM = ("lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || "
       "lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')")

RAW_DATE_TEXT = f"""CASE o_orderkey % 10
  WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
  WHEN 1 THEN {_Y} || '/' || {_M} || '/' || {_D}
  WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' ' || {_HM}
  WHEN 3 THEN lpad({_M}, 2, '0') || '-' || lpad({_D}, 2, '0') || '-' || {_Y}
  WHEN 4 THEN {_Y} || lpad({_M}, 2, '0') || lpad({_D}, 2, '0')
  WHEN 5 THEN 'abc'
  WHEN 6 THEN {_Y}
  WHEN 7 THEN {_Y} || '-13-45'
  WHEN 8 THEN ''
  ELSE NULL END"""

RAW_DATETIME = f"""CASE o_orderkey % 6
  WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' ' || {_HM}
  WHEN 1 THEN {_Y} || '/' || {_M} || '/' || {_D}
  WHEN 2 THEN ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' ' || {_HM} || ':07'
  WHEN 3 THEN 'x ' || {_HM}
  WHEN 4 THEN NULL
  ELSE {_Y} || '-' || {_M} || '-' || {_D} || 'T' || {_HM} END"""

RAW_YEAR = f"""CASE o_orderkey % 8
  WHEN 0 THEN {_Y}
  WHEN 1 THEN {_Y} || '.0'
  WHEN 2 THEN {_Y} || '.5'
  WHEN 3 THEN ' ' || {_Y} || ' '
  WHEN 4 THEN 'abc'
  WHEN 5 THEN ''
  WHEN 6 THEN NULL
  ELSE CASE WHEN o_orderkey % 16 = 7 THEN '0' || CAST(o_orderkey % 1000 AS STRING) || '.0' ELSE {_Y} || '1' END END"""

# invoice code / number / e-number with blanks, leading zeros, 20-digit
# e-numbers, full-width dash and spaces
RAW_CODE = """CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
  ELSE '0' || lpad(CAST(o_custkey AS STRING), 11, '0') END"""
RAW_NUMBER = """CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
  WHEN 2 THEN lpad(CAST(o_orderkey AS STRING), 8, '0') || '－' || CAST(o_orderkey % 7 AS STRING) || '　'
  ELSE lpad(CAST(o_orderkey AS STRING), 8, '0') END"""
RAW_ENO = """CASE o_orderkey % 7 WHEN 0 THEN '2' || lpad(CAST(o_orderkey AS STRING), 19, '0')
  WHEN 1 THEN '  ' WHEN 2 THEN '' WHEN 3 THEN '　' ELSE NULL END"""

_DUCK_WS = "' 　'"


def _raw(df, **exprs):
    return df.select("*", *[F.expr(e).alias(n) for n, e in exprs.items()])


def _duck_num(s: str) -> str:
    return (f"CASE WHEN regexp_full_match({s}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') "
            f"THEN TRY_CAST({s} AS DOUBLE) END")


@bound("parse_numeric", f"""
WITH r AS (SELECT o_orderkey, {RAW_NUMERIC} AS raw FROM orders),
c AS (SELECT o_orderkey, raw, trim(replace(replace(replace(raw, ',', ''), '，', ''), '%', '')) AS s FROM r)
SELECT o_orderkey, raw, {_duck_num('s')} AS value FROM c
""")
def parse_numeric(spark, d):
    o = _raw(table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_custkey"), raw=RAW_NUMERIC)
    return o.select("o_orderkey", "raw", L.parse_numeric("raw").alias("value"))


@bound("parse_tax_rate", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {RAW_RATE} AS raw FROM lineitem),
c AS (SELECT *, trim(COALESCE(raw, '')) AS t FROM r),
k AS (SELECT *, trim(replace(replace(regexp_replace(t, '%+$', ''), ',', ''), '％', '')) AS s FROM c)
SELECT l_orderkey, l_linenumber, raw,
       CASE WHEN t IN ('免税', '不征税', '免征') THEN 0.0 ELSE {_duck_num('s')} END AS rate,
       t IN ('免税', '不征税', '免征') AS is_tax_free
FROM k
""")
def parse_tax_rate(spark, d):
    li = _raw(table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_tax"), raw=RAW_RATE)
    return li.select("l_orderkey", "l_linenumber", "raw", L.parse_tax_rate("raw").alias("rate"),
                     is_tax_free_token("raw").alias("is_tax_free"))


def _duck_ymd(y, m, d):
    return f"TRY_CAST({y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"


_ISO = "'^(\\d{4})[-/.](\\d{1,2})[-/.](\\d{1,2})'"
_US = "'^(\\d{1,2})[-/](\\d{1,2})[-/](\\d{4})'"
_COMPACT = "'^(\\d{4})(\\d{2})(\\d{2})$'"


def _duck_parse_date(s: str) -> str:
    iso = _duck_ymd(f"regexp_extract({s}, {_ISO}, 1)", f"regexp_extract({s}, {_ISO}, 2)",
                    f"regexp_extract({s}, {_ISO}, 3)")
    us = _duck_ymd(f"regexp_extract({s}, {_US}, 3)", f"regexp_extract({s}, {_US}, 1)",
                   f"regexp_extract({s}, {_US}, 2)")
    cp = _duck_ymd(f"regexp_extract({s}, {_COMPACT}, 1)", f"regexp_extract({s}, {_COMPACT}, 2)",
                   f"regexp_extract({s}, {_COMPACT}, 3)")
    serial = (f"CASE WHEN regexp_full_match({s}, '\\d+(\\.\\d+)?') AND TRY_CAST({s} AS DOUBLE) BETWEEN 10000 AND 2958465 "
              f"THEN CAST(DATE '1899-12-30' + CAST(floor(TRY_CAST({s} AS DOUBLE)) AS INTEGER) AS DATE) END")
    return (f"CASE WHEN regexp_matches({s}, {_ISO}) THEN {iso} WHEN regexp_matches({s}, {_US}) THEN {us} "
            f"WHEN regexp_matches({s}, {_COMPACT}) THEN {cp} ELSE {serial} END")


RAW_SERIAL_SPARK = "CAST(unix_date(CAST(o_orderdate AS DATE)) + 25569 AS STRING)"
RAW_SERIAL_DUCK = "CAST(CAST(o_orderdate AS DATE) - DATE '1899-12-30' AS VARCHAR)"


@bound("parse_invoice_date", f"""
WITH r AS (SELECT o_orderkey,
                  CASE WHEN o_orderkey % 13 = 11 THEN {RAW_SERIAL_DUCK}
                       WHEN o_orderkey % 13 = 12 THEN {RAW_SERIAL_DUCK} || '.25'
                       ELSE {RAW_DATE_TEXT} END AS raw FROM orders),
c AS (SELECT o_orderkey, raw, trim(raw, {_DUCK_WS}) AS s FROM r)
SELECT o_orderkey, raw, {_duck_parse_date('s')} AS invoice_date FROM c
""")
def parse_invoice_date(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    raw = (F.when(F.col("o_orderkey") % 13 == 11, F.expr(RAW_SERIAL_SPARK))
           .when(F.col("o_orderkey") % 13 == 12, F.concat(F.expr(RAW_SERIAL_SPARK), F.lit(".25")))
           .otherwise(F.expr(RAW_DATE_TEXT)))
    o = o.withColumn("raw", raw)
    return o.select("o_orderkey", "raw", L.parse_invoice_date("raw").alias("invoice_date"))


@bound("split_date_time", f"""
WITH r AS (SELECT o_orderkey, {RAW_DATETIME} AS raw FROM orders),
c AS (SELECT o_orderkey, raw, trim(raw, {_DUCK_WS}) AS s FROM r),
p AS (SELECT *, regexp_extract(s, '^(\\d{{4}}[/-]\\d{{1,2}}[/-]\\d{{1,2}})', 1) AS dp,
                regexp_extract(s, '(\\d{{1,2}}:\\d{{2}}(:\\d{{2}})?)', 1) AS tp FROM c)
SELECT o_orderkey, raw,
       CASE WHEN dp <> '' THEN {_duck_ymd("split_part(replace(dp, '/', '-'), '-', 1)", "split_part(replace(dp, '/', '-'), '-', 2)", "split_part(replace(dp, '/', '-'), '-', 3)")} END AS invoice_date,
       CASE WHEN tp = '' OR tp IS NULL THEN NULL
            WHEN len(string_split(tp, ':')) = 2 THEN tp || ':00' ELSE tp END AS invoice_time
FROM p
""")
def split_date_time(spark, d):
    o = _raw(table(spark, d, "orders", "o_orderkey", "o_orderdate"), raw=RAW_DATETIME)
    st = L.split_date_time("raw")
    return o.select("o_orderkey", "raw", st["invoice_date"].alias("invoice_date"),
                    st["invoice_time"].alias("invoice_time"))


@bound("normalize_year", f"""
WITH r AS (SELECT o_orderkey, {RAW_YEAR} AS raw FROM orders),
c AS (SELECT o_orderkey, raw,
             regexp_extract(trim(raw, {_DUCK_WS}), '^(?:(\\d{{4}})|([1-9]\\d{{3}})\\.\\d*)$', 1) ||
             regexp_extract(trim(raw, {_DUCK_WS}), '^(?:(\\d{{4}})|([1-9]\\d{{3}})\\.\\d*)$', 2) AS y FROM r)
SELECT o_orderkey, raw, CASE WHEN y <> '' THEN CAST(y AS INTEGER) END AS invoice_year FROM c
""")
def normalize_year(spark, d):
    o = _raw(table(spark, d, "orders", "o_orderkey", "o_orderdate"), raw=RAW_YEAR)
    return o.select("o_orderkey", "raw", L.normalize_year("raw").alias("invoice_year"))


@bound("invoice_year", f"""
WITH r AS (SELECT o_orderkey, {RAW_DATE_TEXT} AS raw FROM orders),
c AS (SELECT o_orderkey, trim(raw, {_DUCK_WS}) AS s FROM r)
SELECT o_orderkey, CAST(year({_duck_parse_date('s')}) AS INTEGER) AS invoice_year FROM c
""")
def invoice_year(spark, d):
    o = _raw(table(spark, d, "orders", "o_orderkey", "o_orderdate"), raw=RAW_DATE_TEXT)
    return o.select("o_orderkey", L.invoice_year(L.parse_invoice_date("raw")).alias("invoice_year"))


def _duck_part(c: str) -> str:
    return f"COALESCE(trim({c}, {_DUCK_WS}), '')"


def _duck_key(code: str, number: str, eno: str) -> str:
    blank_e = f"({eno} IS NULL OR trim({eno}, {_DUCK_WS}) = '')"
    return (f"translate(CASE WHEN NOT {blank_e} THEN {_duck_part(eno)} "
            f"ELSE {_duck_part(code)} || {_duck_part(number)} END, '－　 ', '-')")


@bound("header_uuid", f"""
WITH r AS (SELECT o_orderkey, {RAW_CODE} AS code, {RAW_NUMBER} AS num, {RAW_ENO} AS eno FROM orders)
SELECT o_orderkey, code, num, eno, md5({_duck_key('code', 'num', 'eno')}) AS header_uuid FROM r
""")
def header_uuid(spark, d):
    o = _raw(table(spark, d, "orders", "o_orderkey", "o_custkey"),
             code=RAW_CODE, num=RAW_NUMBER, eno=RAW_ENO)
    return o.select("o_orderkey", "code", "num", "eno",
                    L.header_uuid("code", "num", "eno").alias("header_uuid"))


_LRAW_CODE = RAW_CODE.replace("o_orderkey", "l_orderkey").replace("o_custkey", "l_suppkey")
_LRAW_NUMBER = RAW_NUMBER.replace("o_orderkey", "l_orderkey")
_LRAW_ENO = RAW_ENO.replace("o_orderkey", "l_orderkey")


@bound("detail_uuid", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {_LRAW_CODE} AS code, {_LRAW_NUMBER} AS num, {_LRAW_ENO} AS eno
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
       md5({_duck_key('code', 'num', 'eno')} || CAST(l_linenumber AS VARCHAR)) AS detail_uuid,
       md5({_duck_key('code', 'num', 'eno')}) AS header_uuid
FROM r
""")
def detail_uuid(spark, d):
    li = _raw(table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey"),
              code=_LRAW_CODE, num=_LRAW_NUMBER, eno=_LRAW_ENO)
    return li.select("l_orderkey", "l_linenumber",
                     L.detail_uuid("code", "num", "eno", "l_linenumber").alias("detail_uuid"),
                     L.header_uuid("code", "num", "eno").alias("header_uuid"))


_CODE12 = "'0' || lpad(CAST(o_custkey AS STRING), 11, '0')"
_NUM8 = "lpad(CAST(o_orderkey AS STRING), 8, '0')"
RAW_REMARK = f"""CASE o_orderkey % 7
  WHEN 0 THEN '对应正数发票代码：' || {_CODE12} || '，号码：' || {_NUM8}
  WHEN 1 THEN '冲红 被红冲蓝字发票代码:' || {_CODE12} || ' 被红冲蓝字发票号码:' || {_NUM8}
  WHEN 2 THEN '被红冲蓝字数电票 原号码：2' || lpad(CAST(o_orderkey AS STRING), 19, '0')
  WHEN 3 THEN '被红冲蓝字发票代码' || {_CODE12}
  WHEN 4 THEN '对应正数发票代码' || {_CODE12} || ', 号码' || {_NUM8} || ' 被红冲蓝字发票号码9'
  WHEN 5 THEN 'remark ' || CAST(o_orderkey AS STRING)
  ELSE NULL END"""

_R1, _R2C, _R2N, _R3 = (f"'{p}'" for p in (keys.BLUE_REF_CODE_AND_NUMBER, keys.BLUE_REF_CODE, keys.BLUE_REF_NUMBER,
                                            keys.BLUE_REF_ANY_NUMBER))


@bound("blue_invoice_ref", f"""
WITH r AS (SELECT o_orderkey, {RAW_REMARK} AS bz FROM orders)
SELECT o_orderkey, bz,
  CASE WHEN regexp_matches(bz, {_R1}) THEN regexp_extract(bz, {_R1}, 1) || regexp_extract(bz, {_R1}, 2)
       WHEN regexp_matches(bz, {_R2C}) AND regexp_matches(bz, {_R2N})
            THEN regexp_extract(bz, {_R2C}, 1) || regexp_extract(bz, {_R2N}, 1)
       WHEN regexp_matches(bz, {_R3}) THEN regexp_extract(bz, {_R3}, 1) END AS related_blue_invoice_key
FROM r
""")
def blue_invoice_ref(spark, d):
    o = _raw(table(spark, d, "orders", "o_orderkey", "o_custkey"), bz=RAW_REMARK)
    return o.select("o_orderkey", "bz", L.blue_invoice_ref("bz").alias("related_blue_invoice_key"))


@bound("clean_identifier", f"""
WITH r AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) ||
             CASE o_orderkey % 4 WHEN 0 THEN '.0' WHEN 1 THEN '' WHEN 2 THEN '.5' ELSE '.00' END AS raw FROM orders)
SELECT o_orderkey, raw, regexp_replace(trim(raw, {_DUCK_WS}), '^(-?\\d+)\\.0+$', '\\1') AS ident FROM r
""")
def clean_identifier(spark, d):
    raw = F.expr("CAST(o_custkey AS STRING) || CASE o_orderkey % 4 WHEN 0 THEN '.0' WHEN 1 THEN '' "
                 "WHEN 2 THEN '.5' ELSE '.00' END")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey").withColumn("raw", raw)
    return o.select("o_orderkey", "raw", L.clean_identifier("raw").alias("ident"))


RAW_QTY = """CASE (l_orderkey + l_linenumber) % 4
  WHEN 0 THEN CAST(l_partkey AS STRING) || '.' || lpad(CAST((l_orderkey * 7919 + l_linenumber) % 1000000000 AS STRING), 9, '0')
  WHEN 1 THEN CAST(l_partkey AS STRING) || '.' || lpad(CAST((l_orderkey * 31 + l_linenumber) % 10000 AS STRING), 4, '0')
  WHEN 2 THEN 'abc'
  ELSE CAST(l_partkey AS STRING) || '.' || lpad(CAST((l_orderkey * 7919 + l_linenumber) % 1000000000 AS STRING), 9, '0') || '99' END"""


@bound("truncate_8dp", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {RAW_QTY} AS raw FROM lineitem),
c AS (SELECT *, regexp_replace(trim(raw), '(\\.\\d{{8}})\\d+$', '\\1') AS cut FROM r)
SELECT l_orderkey, l_linenumber, raw,
       CASE WHEN regexp_full_match(cut, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')
            THEN TRY_CAST(cut AS DECIMAL(18,8)) END AS sl
FROM c
""")
def truncate_8dp(spark, d):
    li = _raw(table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey"), raw=RAW_QTY)
    return li.select("l_orderkey", "l_linenumber", "raw", L.truncate_decimals("raw", 8).alias("sl"))


RAW_BLANK = """CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN NULL
  WHEN 3 THEN ' ' || o_orderpriority || ' ' ELSE o_orderpriority END"""


@bound("blank_to_null", f"""
WITH r AS (SELECT o_orderkey, {RAW_BLANK} AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN trim(raw, {_DUCK_WS}) = '' THEN NULL ELSE trim(raw, {_DUCK_WS}) END AS value FROM r
""")
def blank_to_null(spark, d):
    o = _raw(table(spark, d, "orders", "o_orderkey", "o_orderpriority"), raw=RAW_BLANK)
    return o.select("o_orderkey", "raw", L.blank_to_null("raw").alias("value"))


@bound("manifest_file_name", """
SELECT o_orderkey, 'manifest_' || replace(replace(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), ':', '-'), ' ', '_') || '.csv'
       AS file_name
FROM orders
""")
def manifest_file_name(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select("o_orderkey", L.manifest_file_name("manifest", stamp).alias("file_name"))
