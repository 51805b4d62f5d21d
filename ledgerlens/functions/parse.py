"""Row-wise parsers for spreadsheet cells, as Spark column expressions.

Every parser takes a string column and returns a typed column; a value that
does not parse becomes null (ANSI mode is on, so only ``try_*`` casts are
used). Parsers are pure column expressions and stay inside whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import TAX_FREE_TOKENS

# Characters Python's str.strip() removes that Spark's trim() keeps.
WHITESPACE = " \t\n\r\f\v　"

# Plain decimal / scientific number after cleanup. Spark's cast would also
# accept suffixes such as '1d' or '1f'; the guard rejects them.
NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim ASCII and full-width whitespace at both ends."""
    return F.trim(col_(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    """'' or whitespace-only -> null; other values trimmed."""
    s = strip(c)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def is_blank(c) -> Column:
    """True for null and for text that is empty after trimming."""
    return col_(c).isNull() | (strip(c) == "")


def _guarded_double(s: Column) -> Column:
    # anchored extract returns s itself or '' -> one reference to s, so the
    # expression stays cheap when Catalyst inlines it into a filter
    # and '' casts to null
    return F.regexp_extract(s, NUMBER_RE, 0).try_cast(T.DoubleType())


def parse_numeric(c) -> Column:
    """'1,234.56' -> 1234.56; ',', full-width '，' and '%' removed anywhere."""
    s = strip(F.translate(col_(c).cast("string"), ",，%", ""))
    return _guarded_double(s)


_TOKENS_RE = "^(" + "|".join(TAX_FREE_TOKENS) + ")$"


def is_tax_free_token(c) -> Column:
    return strip(F.coalesce(col_(c).cast("string"), F.lit(""))).rlike(_TOKENS_RE)


def parse_tax_rate(c, text_to_zero: bool = True) -> Column:
    """'13%' -> 13, '3' -> 3, '免税' -> 0 (or null when text_to_zero=False).

    Trailing '%' are stripped, ',' and full-width '％' removed anywhere. The
    value is not rescaled: '0.13' stays 0.13.
    """
    s = strip(F.coalesce(col_(c).cast("string"), F.lit("")))
    if text_to_zero:
        s = F.regexp_replace(s, _TOKENS_RE, "0")
    s = strip(F.translate(F.regexp_replace(s, "%+$", ""), ",％", ""))
    return _guarded_double(s)


# Date layouts accepted row by row, first match wins: 'yyyy-m-d' (also '/'
# or '.', anything after the day ignored), month-first 'm-d-yyyy' (also
# '/'), and 'yyyymmdd'. One alternation rewrites each to 'y-m-d': groups of
# the alternatives that did not match are replaced by nothing.
_DATE_LAYOUTS = (r"^(?:(\d{4})[-/.](\d{1,2})[-/.](\d{1,2}).*"
                 r"|(\d{1,2})[-/](\d{1,2})[-/](\d{4}).*"
                 r"|(\d{4})(\d{2})(\d{2}))$")
_TO_YMD = "$1$6$7-$2$4$8-$3$5$9"
_SERIAL = r"^\d+(\.\d+)?$"


def parse_invoice_date(c, serial_base: str = "1899-12-30", min_serial: int = 10000,
                       max_serial: int = 2958465) -> Column:
    """Spreadsheet date text -> DATE, decided per row.

    Accepts 'yyyy-m-d' / 'yyyy/m/d' / 'yyyy.m.d' (time part ignored),
    'mm-dd-yyyy', 'yyyymmdd', and spreadsheet serial day numbers
    (days since ``serial_base``; use '1904-01-01' for 1904-based workbooks).
    Serials outside [min_serial, max_serial] are not dates, so a bare year
    such as '2023' gives null.
    """
    s = strip(c)
    ymd = F.regexp_replace(s, _DATE_LAYOUTS, _TO_YMD)
    serial_num = F.regexp_extract(ymd, _SERIAL, 0).try_cast(T.DoubleType())
    serial = F.when(serial_num.between(min_serial, max_serial),
                    F.date_add(F.to_date(F.lit(serial_base)), F.floor(serial_num).cast("int")))
    # the cast's own date parser (no formatter, no exceptions) on text of
    # exactly y-m-d shape; the shape test keeps '2023' from becoming 2023-01-01.
    # One reference to ymd: a filter would rewrite the text once per reference
    as_date = F.regexp_extract(ymd, r"^\d{4}-\d{1,2}-\d{1,2}\z", 0).try_cast(T.DateType())
    return F.coalesce(as_date, serial)


_DATE_AT_START = r"^(\d{4}[/-]\d{1,2}[/-]\d{1,2})"
_TIME_ANYWHERE = r"(\d{1,2}:\d{2}(:\d{2})?)"


def date_part(c) -> Column:
    """Leading 'yyyy-m-d' / 'yyyy/m/d' of a date-time text -> DATE."""
    s = strip(c)
    raw = F.regexp_extract(s, _DATE_AT_START, 1)
    return F.when(raw != "", F.translate(raw, "/", "-").try_cast(T.DateType()))


def time_part(c) -> Column:
    """First 'h:mm[:ss]' anywhere in the text; ':00' appended when seconds are absent."""
    s = strip(c)
    raw = F.regexp_extract(s, _TIME_ANYWHERE, 1)
    return (F.when(raw == "", F.lit(None).cast("string"))
            .when(F.size(F.split(raw, ":")) == 2, F.concat(raw, F.lit(":00")))
            .otherwise(raw))


def split_date_time(c) -> Column:
    """struct<invoice_date: date, invoice_time: string> from a raw date text."""
    return F.struct(date_part(c).alias("invoice_date"), time_part(c).alias("invoice_time"))


# four digits, or a decimal whose integer part is a four-digit number
# (a dotted value goes through float -> int, so '0999.0' is 999: not a year)
_YEAR = r"^(?:(\d{4})|([1-9]\d{3})\.\d*)$"


def normalize_year(c) -> Column:
    """'2023', '2023.0', 2023.0, '2023.5' -> 2023; '', 'abc', '0999.0', null -> null."""
    s = strip(c)
    y = F.concat(F.regexp_extract(s, _YEAR, 1), F.regexp_extract(s, _YEAR, 2))
    return F.when(y != "", y.cast("int"))


def invoice_year(date_col) -> Column:
    return F.year(col_(date_col))


def clean_identifier(c) -> Column:
    """Identifier text: '1234.0' -> '1234' (float-formatted integers), trimmed."""
    s = strip(c)
    return F.regexp_replace(s, r"^(-?\d+)\.0+$", "$1")


def truncate_decimals(c, scale: int = 8, precision: int = 18) -> Column:
    """Cut (never round) the fraction to ``scale`` digits, then DECIMAL."""
    s = strip(c)
    cut = F.regexp_replace(s, r"(\.\d{%d})\d+$" % scale, "$1")
    return F.nullif(F.regexp_extract(cut, NUMBER_RE, 0), F.lit("")).try_cast(T.DecimalType(precision, scale))


def to_money(c) -> Column:
    """Numeric text or number -> DECIMAL(18,2), never through a double."""
    s = strip(F.translate(col_(c).cast("string"), ",，%", ""))
    return F.nullif(F.regexp_extract(s, NUMBER_RE, 0), F.lit("")).try_cast(T.DecimalType(18, 2))


def stamp_in_file_name(c) -> Column:
    """A time stamp's text in a form that file names allow."""
    return F.translate(col_(c).cast("string"), ": ", "-_")


def manifest_file_name(prefix: str, stamp) -> Column:
    return F.concat(F.lit(f"{prefix}_"), stamp_in_file_name(stamp), F.lit(".csv"))
