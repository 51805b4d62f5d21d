"""Header and detail import from spreadsheet exports, end to end.

``import_headers`` / ``import_details`` read every workbook under a folder,
pick the sheet to load per file, rename spreadsheet titles to table
columns, reject rows without a usable invoice key, build the keys (and line
numbers for details), parse dates, amounts and remarks, quarantine keys
repeated in the batch or already in the ledger, split off rows without a
year, and append the rest to the year-partitioned ledger.

Every step is a DataFrame transformation; the only driver-side values are
the column lists.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import functions as L
from ledgerlens.keyindex import KeyIndex
from ledgerlens.operators.dedup import logic_line_no, quarantine, repeated_keys
from ledgerlens.operators.filters import split_missing_year, valid_invoice_keys
from ledgerlens.operators.sheets import best_sheet_by_overlap
from ledgerlens.session import STAGE_CODEC, compilable_methods, path_exists, remove_path, scratch_path, small_scans, stored_bytes
from ledgerlens.schemas import (
    DEFAULT_CREATED_BY, DEFAULT_SOURCE_SYSTEM, DEFAULT_TOLERANCE, DETAIL_TITLE_MAP, HEADER_TITLE_MAP, UNCHECKED,
)
from ledgerlens.sinks import write_partitioned
from ledgerlens.sources import xlsx

# fixed values: sheet-name markers of the two exports
HEADER_SHEET_MARK = "发票基础信息"
SUMMARY_SHEET_PREFIX = "信息汇总表"
#: bytes of a stage table from which its rows are written by year without a shuffle
LARGE_BATCH = 512 << 20


@dataclass
class ImportResult:
    accepted: DataFrame        # rows written to the ledger
    quarantined: DataFrame     # repeated in batch / already imported (with reason)
    rejected_keys: DataFrame   # no usable invoice key (with reason)
    missing_year: DataFrame    # no parseable invoice date
    sheets: DataFrame          # the sheet chosen per file
    errors: DataFrame          # unreadable, oversized and unsupported files as error-log rows
    staged: tuple[str, ...] = ()

    def release(self, spark: SparkSession) -> None:
        """Remove the import's stage tables, once its frames are used up."""
        for path in self.staged:
            remove_path(spark, path)


def _chosen_rows(rows: DataFrame, chosen: DataFrame, title_map: dict[str, str]) -> DataFrame:
    """Rows of the chosen sheets, titles renamed to columns. Rows were read
    with ``cells`` aligned to ``title_map``'s titles, so each column is a
    positional lookup."""
    # a row per file: broadcast, so that no row of a sheet is shuffled
    data = xlsx.data_rows(rows).join(F.broadcast(chosen.select("file", "sheet")), ["file", "sheet"], "left_semi")
    return data.select(F.col("file").alias("source_file"), F.col("sheet").alias("source_sheet"),
                       F.col("row_no"),
                       *[F.col("cells")[i].alias(c) for i, c in enumerate(title_map.values())])


def _common(df: DataFrame, batch_id: str, batch_ts: str) -> DataFrame:
    for c in ("fpdm", "fphm", "sdfphm"):
        df = df.withColumn(c, F.when(~L.is_blank(c), L.clean_identifier(c)))
    dt = L.split_date_time("kprq")
    return df.withColumns({
        "invoice_date": F.coalesce(dt["invoice_date"], L.parse_invoice_date("kprq")), "invoice_time": dt["invoice_time"],
        "je": L.to_money("je"), "se": L.to_money("se"), "jshj": L.to_money("jshj"),
        "import_batch_id": F.lit(batch_id), "source_system": F.lit(DEFAULT_SOURCE_SYSTEM),
        "clean_status": F.lit(None).cast("string"), "sync_status": F.lit(None).cast("string"),
        "import_ts": F.lit(batch_ts).cast("timestamp_ntz"),
    })


def _rows(spark: SparkSession, path: str, batch_id: str, titles: list[str] | str | None = None,
          max_mb: float | None = 500.0) -> DataFrame:
    return xlsx.stage_workbooks(spark, path, scratch_path(spark, f"raw-rows-{batch_id}-{uuid.uuid4().hex[:12]}"),
                                titles=titles, max_mb=max_mb)


def _paths(*staged: DataFrame) -> tuple[str, ...]:
    """The folders of stage tables."""
    return tuple(sorted({f.rsplit("/", 1)[0] for df in staged for f in df.inputFiles()}))


def _bytes(spark: SparkSession, staged: DataFrame) -> int:
    return sum(stored_bytes(spark, path) for path in _paths(staged))


def _stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write the keyed rows once to the shared checkpoint folder and read
    them back: the key index and quarantine read them, and the parse, line
    numbers and keys must not be computed twice."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    with compilable_methods(spark), small_scans(spark):
        df.write.mode("overwrite").option(*STAGE_CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _finish(spark, df, key, ledger, mode, rejected, chosen, batch_id, rows, tolerant) -> ImportResult:
    df = _stage(spark, df, f"keyed-{batch_id}")
    known = None
    if ledger and path_exists(spark, ledger):
        known = _stage(spark, KeyIndex(spark, ledger, key).known(df, tolerant), f"known-{batch_id}")
    repeats = None
    if mode == "reject_all":
        # counted over the key column alone; few of them are broadcast to the rows
        repeats = _stage(spark, repeated_keys(df.filter(F.col(key).isNotNull()), key).select(key), f"repeats-{batch_id}")
    accepted, held = quarantine(df, key, known_keys=known, mode=mode, order=["source_file", "source_sheet", "row_no"], reduced=True,
                                repeats=repeats)
    accepted = accepted.withColumn("invoice_year", L.invoice_year("invoice_date"))
    with_year, no_year = split_missing_year(accepted, "invoice_year")
    if ledger:
        # a large batch fills its tasks' files as it stands: not dealt to the years once more
        write_partitioned(with_year, ledger, mode="append", rebalance=_bytes(spark, df) < LARGE_BATCH)
        # the written rows, read back (no second evaluation of the import)
        with_year = spark.read.parquet(ledger).filter(F.col("import_batch_id") == batch_id)
    return ImportResult(with_year, held, rejected, no_year, chosen, xlsx.error_rows(rows),
                        _paths(rows, df, *[x for x in (known, repeats) if x is not None]))


def header_frame(rows: DataFrame, batch_id: str, batch_ts: str, min_overlap: int = 5, catalogue: DataFrame | None = None):
    """``(keyed, rejected, sheets)`` of workbook rows read with the header
    titles: the header sheet ('发票基础信息…') of every workbook, its rows with
    keys and parsed values, and the rows without a usable key. ``catalogue``
    gives the sheets of the rows where the caller has them already."""
    cat = (xlsx.sheet_catalogue(rows) if catalogue is None else catalogue).filter(F.col("sheet").contains(HEADER_SHEET_MARK))
    chosen = best_sheet_by_overlap(cat, list(HEADER_TITLE_MAP), min_overlap, prefer_prefix=None)
    df = _chosen_rows(rows, chosen, HEADER_TITLE_MAP)
    ok, rejected = valid_invoice_keys(df, "fpdm", "fphm", "sdfphm")
    h = _common(ok, batch_id, batch_ts).withColumns({
        "header_uuid": L.header_uuid("fpdm", "fphm", "sdfphm"),
        "related_blue_invoice_uuid": L.blue_invoice_ref("bz"),
        "created_at": F.lit(batch_ts).cast("timestamp_ntz"), "created_by": F.lit(DEFAULT_CREATED_BY),
        "is_balanced": F.lit(UNCHECKED), "balance_tolerance": F.lit(DEFAULT_TOLERANCE).cast("decimal(18,2)"),
    })
    return h, rejected, chosen


def detail_frame(rows: DataFrame, batch_id: str, batch_ts: str, min_overlap: int = 3,
                 line_scope=("source_file", "source_sheet"), catalogue: DataFrame | None = None):
    """As ``header_frame``, for the detail sheet: one named '信息汇总表…' wins,
    else the sheet sharing most detail titles (≥ min_overlap)."""
    chosen = best_sheet_by_overlap(xlsx.sheet_catalogue(rows) if catalogue is None else catalogue, list(DETAIL_TITLE_MAP), min_overlap,
                                   prefer_prefix=SUMMARY_SHEET_PREFIX)
    df = _chosen_rows(rows, chosen, DETAIL_TITLE_MAP)
    ok, rejected = valid_invoice_keys(df, "fpdm", "fphm", "sdfphm")
    d = _common(ok, batch_id, batch_ts).withColumn("__inv", L.invoice_key("fpdm", "fphm", "sdfphm"))
    d = logic_line_no(d, "__inv", ["source_file", "source_sheet", "row_no"], scope=line_scope)
    d = d.withColumns({
        "header_uuid": F.md5(F.col("__inv")),
        "detail_uuid": F.md5(F.concat("__inv", F.col("logic_line_no").cast("string"))),  # L.detail_uuid of the key at hand
        "sl": L.truncate_decimals("sl", 8), "dj": L.truncate_decimals("dj", 8),
        "updated_at": F.lit(None).cast("timestamp_ntz"), "updated_by": F.lit(None).cast("string"),
    }).drop("__inv")
    return d, rejected, chosen


def import_headers(spark: SparkSession, path: str, batch_id: str, batch_ts: str, ledger: str | None = None,
                   min_overlap: int = 5, mode: str = "reject_all", max_mb: float | None = 500.0,
                   tolerant: bool = False) -> ImportResult:
    """Import the header sheet ('发票基础信息…') of every workbook under ``path``
    (files above ``max_mb`` are reported in ``errors``). With ``tolerant`` a
    key is known when its trimmed, lower-cased text is that of a ledger key."""
    rows = _rows(spark, path, batch_id, list(HEADER_TITLE_MAP), max_mb)
    h, rejected, chosen = header_frame(rows, batch_id, batch_ts, min_overlap)
    return _finish(spark, h, "header_uuid", ledger, mode, rejected, chosen, batch_id, rows, tolerant)


def import_details(spark: SparkSession, path: str, batch_id: str, batch_ts: str, ledger: str | None = None,
                   min_overlap: int = 3, mode: str = "reject_all",
                   line_scope=("source_file", "source_sheet"), max_mb: float | None = 500.0,
                   tolerant: bool = False) -> ImportResult:
    """Import the detail sheet of every workbook under ``path`` (see
    ``detail_frame``); files above ``max_mb`` are reported in ``errors``;
    ``tolerant`` as in ``import_headers``."""
    rows = _rows(spark, path, batch_id, list(DETAIL_TITLE_MAP), max_mb)
    d, rejected, chosen = detail_frame(rows, batch_id, batch_ts, min_overlap, line_scope)
    return _finish(spark, d, "detail_uuid", ledger, mode, rejected, chosen, batch_id, rows, tolerant)


@dataclass
class LedgerBuild:
    ledger: DataFrame          # kept rows, year-partitioned
    duplicates: DataFrame      # later copies of a dedup key, with capture time
    metrics: DataFrame         # rows before / after / dropped per year
    cast_stats: DataFrame      # per (file, sheet, column, method)
    cast_failures: DataFrame   # one row per value that did not parse
    manifest: DataFrame        # one row per sheet
    anomalies: DataFrame       # tax-rate anomalies over the ledger
    missing_year: DataFrame    # rows without a parseable invoice date
    errors: DataFrame          # unreadable, oversized and unsupported files as error-log rows


def build_ledger_from_workbooks(spark: SparkSession, path: str, ledger: str, batch_ts: str,
                                kind="summary", keys=None, max_mb: float | None = 500.0) -> LedgerBuild:
    """Scan, classify, cast and record, then dedup into the year ledger.

    Sheets of class ``kind`` (one class or several; 'summary' and 'detail'
    sheets feed the detail ledger, 'header' sheets the header ledger, and
    'special' stands for every special class, whose rows keep their target
    table) are united by title (missing titles null), dates, amounts and rates are
    parsed next to their text with statistics and failure rows, the year
    comes from the parsed date, rows are de-duplicated keep-first on the
    dedup titles present (arrival order: file, sheet, row), the ledger is
    written partitioned by year and the tax-rate rule runs over it.
    """
    from ledgerlens.operators import audit, dedup, filters, sheets as sh
    from ledgerlens.schemas import DETAIL_DEDUP_COLUMNS, HEADER_DEDUP_COLUMNS, INVOICE_DATE
    rows = _rows(spark, path, f"ledger-{uuid.uuid4().hex[:8]}", xlsx.IN_PLACE, max_mb)
    # a row per sheet, read out of the rows once
    catalogue = _stage(spark, sh.classify_sheets(xlsx.sheet_catalogue(rows), "sheet"), "sheets")
    manifest = sh.sheet_manifest(catalogue, xlsx.data_rows(rows))
    kinds = [kind] if isinstance(kind, str) else list(kind)
    wanted = F.col("classification").isin(kinds)
    if "special" in kinds:
        wanted = wanted | F.col("classification").startswith("special:")
    picked = catalogue.filter(wanted).withColumn("target_table", sh.target_table("classification"))
    titles = xlsx.titles_of(picked)
    # the sheets are broadcast, so that no row of a sheet is shuffled
    data = xlsx.in_place_table(rows, picked, titles, ["target_table"]).withColumnRenamed("row_no", "row_index")
    specs = {c: k for c, k in (("开票日期", audit.DATE), ("金额", audit.NUMERIC), ("税额", audit.NUMERIC),
                               ("单价", audit.NUMERIC), ("数量", audit.NUMERIC), ("价税合计", audit.NUMERIC),
                               ("税率", audit.TAX_RATE)) if c in titles}
    keys_present = [c for c in ("发票代码", "发票号码") if c in titles]
    # parsed once and written: the typed rows, the statistics and the failures read it
    parsed = _stage(spark, audit.parse_once(data, specs), "parsed")
    stats = audit.stats_from(parsed, specs)
    failures = audit.failures_from(parsed, specs, keys=keys_present)
    typed = audit.typed_from(parsed, specs).withColumn("invoice_year", L.invoice_year(INVOICE_DATE))
    typed, no_year = filters.split_missing_year(typed, "invoice_year")
    default_keys = HEADER_DEDUP_COLUMNS if kinds == ["header"] else DETAIL_DEDUP_COLUMNS
    dedup_keys = ["target_table", *[c for c in (keys or default_keys) if c in titles]]
    order = ["file", "sheet", "row_index"]
    flagged = _stage(spark, dedup.flag_duplicates(typed, dedup_keys, order, flag="is_duplicate", stored=True), "flagged")
    metrics = dedup.dedup_metrics(flagged, "invoice_year", kind="header" if kinds == ["header"] else "detail")
    kept = flagged.filter(~F.col("is_duplicate")).drop("is_duplicate")
    dups = (flagged.filter(F.col("is_duplicate")).drop("is_duplicate")
            .withColumn("dedup_captured_at", F.lit(batch_ts).cast("timestamp_ntz")))
    write_partitioned(kept, ledger, rebalance=_bytes(spark, flagged) < LARGE_BATCH)
    written = spark.read.parquet(ledger)
    rate_num = "税率" + audit.RATE_NUM_SUFFIX
    anomalies = (filters.tax_rate_anomaly(written, rate_num, "税率")
                 if rate_num in written.columns else written.limit(0))
    return LedgerBuild(written, dups, metrics, stats, failures, manifest, anomalies, no_year, xlsx.error_rows(rows))


def check_quality(spark: SparkSession, header: str, detail: str, checked_at: str, checked_by: str,
                  **options) -> tuple[DataFrame, DataFrame]:
    """Run the quality pass over the stored header and detail ledgers and
    write both back, year by year; returns them read again. ``options`` are
    those of ``quality.run_dq``."""
    from ledgerlens.operators.quality import run_dq
    staged = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        staged.append(_stage(spark, df, name))
        return staged[-1]

    h, d = run_dq(spark.read.parquet(header), spark.read.parquet(detail), checked_at=checked_at,
                  checked_by=checked_by, stage=stage, **options)
    h = stage(h, "dq-header")  # both are stored before either ledger changes
    for frame, path in ((h, header), (d, detail)):
        write_partitioned(frame, path, rebalance=_bytes(spark, frame) < LARGE_BATCH)
    for path in _paths(*staged):
        remove_path(spark, path)
    return spark.read.parquet(header), spark.read.parquet(detail)
