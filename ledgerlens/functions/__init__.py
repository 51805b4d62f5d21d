"""Column-expression functions: parsers, keys, error enrichment."""

from ledgerlens.functions.errors import error_category, error_suggestion
from ledgerlens.functions.keys import blue_invoice_ref, detail_uuid, header_uuid, invoice_key
from ledgerlens.functions.parse import (
    blank_to_null, clean_identifier, date_part, invoice_year, is_blank, manifest_file_name,
    normalize_year, parse_invoice_date, parse_numeric, parse_tax_rate, split_date_time, stamp_in_file_name, strip, time_part,
    to_money, truncate_decimals,
)

__all__ = [
    "blank_to_null", "blue_invoice_ref", "clean_identifier", "date_part", "detail_uuid",
    "error_category", "error_suggestion", "header_uuid", "invoice_key", "invoice_year",
    "is_blank", "manifest_file_name", "normalize_year", "parse_invoice_date", "parse_numeric", "parse_tax_rate",
    "split_date_time", "stamp_in_file_name", "strip", "time_part", "to_money", "truncate_decimals",
]
