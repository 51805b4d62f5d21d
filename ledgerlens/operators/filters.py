"""Row filters that split a frame into a kept side and a rejected side.

Split operators return ``(kept, rejected)``; ``rejected`` carries a
``reject_reason`` column so nothing is silently dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.parse import is_blank, strip
from ledgerlens.schemas import (
    EXPECTED_RATE_FRACTIONS, LEGAL_RATE_TEXTS, LEGAL_RATES,
)


def invoice_key_reject_reason(code, number, e_number) -> Column:
    """Why a row cannot be keyed, or null when it can.

    'no_invoice_key': code, number and e-number all blank;
    'partial_paper_key': exactly one of code/number given and no e-number.
    Null and blank-after-trim both count as empty.
    """
    has_c, has_n, has_e = ~is_blank(code), ~is_blank(number), ~is_blank(e_number)
    return (F.when(~has_c & ~has_n & ~has_e, "no_invoice_key")
            .when((has_c != has_n) & ~has_e, "partial_paper_key"))


def valid_invoice_keys(df: DataFrame, code: str, number: str, e_number: str):
    """(valid, rejected) by invoice-key completeness."""
    reason = invoice_key_reject_reason(code, number, e_number)
    tagged = df.withColumn("reject_reason", reason)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))


def split_missing_year(df: DataFrame, year: str = "invoice_year"):
    """(with year, without year): rows without a year cannot be partitioned."""
    return (df.filter(F.col(year).isNotNull()),
            df.filter(F.col(year).isNull()).withColumn("reject_reason", F.lit("missing_year")))


# fixed values: key texts that mean "no key"
INVALID_KEY_TEXTS = ["", "none", "nan"]


def valid_key_text(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is null, '' or 'none'/'nan' (any case, trimmed)."""
    k = F.lower(strip(key))
    return df.filter(F.col(key).isNotNull() & ~k.isin(INVALID_KEY_TEXTS))


def tax_rate_anomaly(df: DataFrame, rate_num: str, rate_text: str,
                     legal=tuple(LEGAL_RATES), legal_text=tuple(LEGAL_RATE_TEXTS)) -> DataFrame:
    """Rows whose numeric rate is outside ``legal`` or, when no numeric rate,
    whose raw text is outside ``legal_text``.

    SQL three-valued logic is kept on purpose: a row with null numeric rate
    and null text is not flagged.
    """
    n, t = F.col(rate_num), F.col(rate_text)
    # n.isin(...) is null exactly when n is null, so coalesce picks the text
    # test for those rows; each column is referenced once, which keeps the
    # condition cheap when Catalyst inlines the parsed rate into the filter
    return df.filter(F.coalesce(~n.isin(list(legal)), ~t.isin(list(legal_text))))


def tax_rate_unexpected(df: DataFrame, rate: str, expected=tuple(EXPECTED_RATE_FRACTIONS),
                        detected_at=None, anomaly_type: str = "TAX_RATE_UNEXPECTED",
                        year_from: str | None = None) -> DataFrame:
    """Rows whose rate is not one of ``expected``; a null rate is flagged too.

    Adds ``anomaly_type``, ``detected_at`` and (from ``year_from``) ``invoice_year``.
    """
    r = F.col(rate)
    out = df.filter(~F.coalesce(r.isin(list(expected)), F.lit(False)))
    out = out.withColumn("anomaly_type", F.lit(anomaly_type))
    if detected_at is not None:
        out = out.withColumn("detected_at", F.lit(detected_at).cast("timestamp_ntz"))
    if year_from is not None:
        out = out.withColumn("invoice_year", F.year(F.col(year_from)))
    return out


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """The table after ``DELETE WHERE predicate``: rows where the predicate is
    not true stay (a null predicate keeps the row, as in SQL)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))
