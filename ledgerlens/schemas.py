"""Table schemas, column maps and business constants.

Everything under "fixed values" must equal the source system's values for
results to match (column titles of the spreadsheet exports, status labels,
tax tokens). They are stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# fixed values: spreadsheet column titles
# ---------------------------------------------------------------------------
INVOICE_CODE = "发票代码"
INVOICE_NUMBER = "发票号码"
E_INVOICE_NUMBER = "数电发票号码"
INVOICE_DATE = "开票日期"

# Spreadsheet title -> header table column (one row per invoice).
HEADER_TITLE_MAP = {
    "发票代码": "fpdm", "发票号码": "fphm", "数电发票号码": "sdfphm",
    "销方识别号": "xfsbh", "销方名称": "xfmc", "购方识别号": "gfsbh",
    "购买方名称": "gfmc", "开票日期": "kprq", "金额": "je", "税额": "se",
    "价税合计": "jshj", "发票来源": "fply", "发票票种": "fppz",
    "发票状态": "fpzt", "是否正数发票": "sfzsfp", "发票风险等级": "fpfxdj",
    "开票人": "kpr", "备注": "bz",
}

# Spreadsheet title -> detail table column (one row per invoice line).
DETAIL_TITLE_MAP = {
    "发票代码": "fpdm", "发票号码": "fphm", "数电发票号码": "sdfphm",
    "销方识别号": "xfsbh", "销方名称": "xfmc", "购方识别号": "gfsbh",
    "购买方名称": "gfmc", "开票日期": "kprq", "税收分类编码": "ssflbm",
    "特定业务类型": "tdywlx", "货物或应税劳务名称": "hwlwmc", "规格型号": "ggxh",
    "单位": "dw", "数量": "sl", "单价": "dj", "金额": "je", "税率": "slv",
    "税额": "se", "价税合计": "jshj", "发票来源": "fply", "发票票种": "fppz",
    "发票状态": "fpzt", "是否正数发票": "sfzsfp", "发票风险等级": "fpfxdj",
    "开票人": "kpr", "备注": "bz",
}

# Standard header-sheet column order used by the column re-orderer.
HEADER_STANDARD_ORDER = [
    "发票代码", "发票号码", "数电发票号码", "销方识别号", "销方名称", "购方识别号",
    "购买方名称", "开票日期", "金额", "税额", "价税合计", "发票来源", "发票票种",
    "发票状态", "是否正数发票", "发票风险等级", "开票人", "备注",
]

# Ledger dedup keys.
DETAIL_DEDUP_COLUMNS = [
    "发票代码", "发票号码", "数电发票号码", "开票日期", "货物或应税劳务名称", "数量",
    "单价", "金额", "税额", "发票票种", "发票状态", "开票人", "备注",
]
HEADER_DEDUP_COLUMNS = ["发票代码", "发票号码", "数电发票号码"]

# ---------------------------------------------------------------------------
# fixed values: status labels and defaults
# ---------------------------------------------------------------------------
UNCHECKED = "未校验"          # is_balanced before any check
BALANCED = "平账"
WITHIN_TOLERANCE = "差异可接受"
UNBALANCED = "不平账"
FORCED = "强制通过"           # manual override, never touched

DUPLICATE_KEY = "UUID重复"    # clean_status for later copies of a key
HEADER_MISSING = "主表缺失"   # detail line whose header is absent
DETAIL_MISSING = "明细缺失"   # header without any detail line

DEFAULT_TOLERANCE = "0.1"
DEFAULT_CREATED_BY = "SYSTEM"
DEFAULT_SOURCE_SYSTEM = "金税导出"

# Tax-rate text tokens meaning "no tax".
TAX_FREE_TOKENS = ["免税", "不征税", "免征"]
# Legal numeric rates (percent) and legal raw texts for the anomaly rule.
LEGAL_RATES = [13, 9, 6, 3, 0]
LEGAL_RATE_TEXTS = ["13", "9", "6", "3", "0", "0%", "0.00%", "0.0%", "免税", "不征税", "免征"]
# Rates the second anomaly rule expects (fractions).
EXPECTED_RATE_FRACTIONS = [0.13, 0.06]

# ---------------------------------------------------------------------------
# fixed values: typed target schema of the header ledger
# ---------------------------------------------------------------------------
MONEY = T.DecimalType(18, 2)


def _s(name, t=T.StringType()):
    return T.StructField(name, t, True)


HEADER_SCHEMA = T.StructType(
    [_s("header_uuid"), _s("created_at", T.TimestampNTZType()), _s("created_by"),
     _s("updated_at", T.TimestampNTZType()), _s("updated_by"), _s("import_batch_id"),
     _s("source_system"), _s("source_file"), _s("sync_status"), _s("clean_status"),
     _s("detail_total_amount", MONEY), _s("is_balanced"), _s("balance_diff", MONEY),
     _s("balance_tolerance", MONEY), _s("balance_check_time", T.TimestampNTZType()),
     _s("balance_check_by"), _s("balance_notes"), _s("related_blue_invoice_uuid")]
    + [_s(c) for c in ["fpdm", "fphm", "sdfphm", "xfsbh", "xfmc", "gfsbh", "gfmc", "kprq"]]
    + [_s("invoice_date", T.DateType()), _s("invoice_time")]
    + [_s(c, MONEY) for c in ["je", "se", "jshj"]]
    + [_s(c) for c in ["fply", "fppz", "fpzt", "sfzsfp", "fpfxdj", "kpr", "bz"]]
    + [_s("invoice_year", T.IntegerType()), _s("source_sheet"), _s("row_no", T.IntegerType())]
)
