"""Golden cases for the row-wise parsers and keys."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlens import functions as L


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


# year normalisation: input -> expected (the source system's own table-driven cases)
YEAR_CASES = [("2023", 2023), ("2023.0", 2023), ("2021.0", 2021), ("2022.0", 2022), ("2024.0", 2024),
              ("2025.0", 2025), ("abc", None), ("", None), (None, None), ("2023.5", 2023)]


def test_normalize_year_text(spark):
    got = _eval(spark, [c for c, _ in YEAR_CASES], L.normalize_year)
    assert got == [e for _, e in YEAR_CASES]


def test_normalize_year_edges(spark):
    # a dotted value goes through float -> int: its integer part must have 4 digits
    got = _eval(spark, ["0999.0", "2023.", " 2023.0 ", "12023.0", "-2023.0", "0999"], L.normalize_year)
    assert got == [None, 2023, 2023, None, None, 999]


def test_normalize_year_numeric(spark):
    assert _eval(spark, [2023.0, 2023.5], L.normalize_year, "double") == [2023, 2023]
    assert _eval(spark, [2023], L.normalize_year, "int") == [2023]


def test_parse_numeric(spark):
    got = _eval(spark, ["1,234.56", "  1000 ", "n/a", "", None, "13%", "1d", "1，000", "-1e2"], L.parse_numeric)
    assert got == [1234.56, 1000.0, None, None, None, 13.0, None, 1000.0, -100.0]


def test_parse_tax_rate(spark):
    vals = ["13%", "免税", "0", "3%", "abc", " 13 ", "9％", None, "0.13", "不征税"]
    assert _eval(spark, vals, L.parse_tax_rate) == [13.0, 0.0, 0.0, 3.0, None, 13.0, 9.0, None, 0.13, 0.0]
    no_zero = _eval(spark, vals, lambda c: L.parse_tax_rate(c, text_to_zero=False))
    assert no_zero[1] is None and no_zero[9] is None


def test_parse_invoice_date(spark):
    vals = ["2021-01-01", "2021/02/02", "01-03-2021", "", "2023-1-5", "2023/01/05", "44197",
            "2023-01-05 10:11", "abc", "2023", "20230105", "2023-13-45"]
    got = _eval(spark, vals, L.parse_invoice_date)
    d = dt.date
    assert got == [d(2021, 1, 1), d(2021, 2, 2), d(2021, 1, 3), None, d(2023, 1, 5), d(2023, 1, 5),
                   d(2021, 1, 1), d(2023, 1, 5), None, None, d(2023, 1, 5), None]


def test_parse_invoice_date_1904(spark):
    got = _eval(spark, ["0", "1"], lambda c: L.parse_invoice_date(c, serial_base="1904-01-01", min_serial=0))
    assert got == [dt.date(1904, 1, 1), dt.date(1904, 1, 2)]


def test_split_date_time(spark):
    df = spark.createDataFrame([("2023/1/5 9:07",), ("2023-01-05 10:11:12",), ("abc",), (None,)], "v string")
    rows = df.select(L.split_date_time("v").alias("s")).collect()
    assert [(r.s.invoice_date, r.s.invoice_time) for r in rows] == [
        (dt.date(2023, 1, 5), "9:07:00"), (dt.date(2023, 1, 5), "10:11:12"), (None, None), (None, None)]


def _md5(s):
    return hashlib.md5(s.encode("utf-8")).hexdigest()


def test_header_and_detail_uuid(spark):
    rows = [("001", "0000123", None, 1), (None, None, "24440000000000000001", 2),
            ("1100－23", "00 01　", "  ", 3), ("C1", None, None, 1)]
    df = spark.createDataFrame(rows, "c string, n string, e string, l int")
    out = df.select(L.header_uuid("c", "n", "e").alias("h"), L.detail_uuid("c", "n", "e", "l").alias("d")).collect()
    assert out[0].h == _md5("0010000123") and out[0].d == _md5("00100001231")
    assert out[1].h == _md5("24440000000000000001")
    assert out[2].h == _md5("1100-230001")
    assert out[3].h == _md5("C1")


def test_blue_invoice_ref(spark):
    vals = ["对应正数发票代码：011001900111，号码：12345678",
            "被红冲蓝字发票代码:1100190011 被红冲蓝字发票号码:87654321",
            "被红冲蓝字数电票号码：24440000000000000001",
            "被红冲蓝字发票代码1100190011", "普通备注", None]
    assert _eval(spark, vals, L.blue_invoice_ref) == [
        "01100190011112345678", "110019001187654321", "24440000000000000001", None, None, None]


def test_truncate_and_identifiers(spark):
    assert [str(x) if x is not None else None for x in
            _eval(spark, ["1.123456789", "2.5", "x"], lambda c: L.truncate_decimals(c, 8))] == \
        ["1.12345678", "2.50000000", None]
    assert _eval(spark, ["123.0", "123", "12.5", " 7.00 "], L.clean_identifier) == ["123", "123", "12.5", "7"]
    assert _eval(spark, ["", "  ", " a ", None], L.blank_to_null) == [None, None, "a", None]


@pytest.mark.parametrize("etype,msg,expected_key", [
    ("FileNotFoundError", None, "FileNotFoundError"),
    ("Weird", "Permission denied on x", "PermissionError"),
    ("Weird", "file is corrupt", "InvalidFileException"),
    (None, "whatever", None),
])
def test_error_suggestion(spark, etype, msg, expected_key):
    from ledgerlens.functions.errors import SUGGESTIONS
    df = spark.createDataFrame([(etype, msg)], "t string, m string")
    got = df.select(L.error_suggestion("t", "m").alias("s")).first().s
    assert got == (SUGGESTIONS[expected_key] if expected_key else "")
