"""Streaming import of workbooks from a landing folder.

``readStream`` lists new workbooks (Spark's file log remembers which were
taken); each micro-batch is parsed into rows, keyed as in the batch import,
and goes through ``import_batch``: of rows with one key the first by file
time, path, sheet and row is accepted, over all files ever seen. Every table
is written into the folder of the micro-batch's epoch, so a repeated
micro-batch replaces itself. An unreadable workbook gives an error
row and holds up nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import functions as L
from ledgerlens import ingest
from ledgerlens.operators.filters import split_missing_year
from ledgerlens.schemas import DETAIL_TITLE_MAP, HEADER_TITLE_MAP
from ledgerlens.session import STAGE_CODEC, compilable_methods, remove_path, scratch_path, sized_shuffles, stored_bytes
from ledgerlens.sources import xlsx
from ledgerlens.streaming.incremental import FILE_ORDER, import_batch, together, write_epoch

_FILES = "path string, modificationTime timestamp, length long, content binary"
_KINDS = {"header": (HEADER_TITLE_MAP, ingest.header_frame, "header_uuid"),
          "detail": (DETAIL_TITLE_MAP, ingest.detail_frame, "detail_uuid")}


def import_workbooks(files: DataFrame, epoch: int, kind: str, target: str, side: str, batch: str, batch_ts: str,
                     max_mb: float | None = 500.0) -> None:
    """Import one micro-batch of listed workbooks: accepted rows to
    ``target``; repeated and known ones, rows without key or year, and files
    that could not be read to ``side/quarantine``, ``side/rejected`` and
    ``side/errors``."""
    spark = files.sparkSession
    titles = _KINDS[kind][0]
    stage = scratch_path(spark, f"{batch}-{epoch}-{uuid.uuid4().hex[:12]}")
    # each workbook is parsed once; it is taken whole or not at all, its rows go with its error. A few workbooks keep
    # few tasks busy: their rows are dealt to as many as they are worth before they are keyed
    with sized_shuffles(spark, files.agg(F.sum("length")).first()[0] or 0):
        (xlsx.parse_files(files, list(titles), max_mb, whole=False).union(xlsx.unread(files, max_mb))
         .repartition("file", "sheet", "row_no").write.option(*STAGE_CODEC).parquet(f"{stage}/rows"))
    with sized_shuffles(spark, stored_bytes(spark, f"{stage}/rows")), compilable_methods(spark):
        _import_rows(spark, files, stage, epoch, kind, target, side, batch, batch_ts)
    remove_path(spark, stage)


def _import_rows(spark: SparkSession, files: DataFrame, stage: str, epoch: int, kind: str, target: str, side: str,
                 batch: str, batch_ts: str) -> None:
    """Import the rows that a micro-batch's workbooks gave, stored in ``stage``."""
    _, keyed, key = _KINDS[kind]
    stored = spark.read.schema(xlsx.ROW_SCHEMA).parquet(f"{stage}/rows")
    # the sheets and failed files, a row each, are read once and stand in the queries as they are
    known = spark.createDataFrame(stored.filter("columns is not null or error is not null")
                                  .select("file", "sheet", "sheet_index", "columns", "error").toArrow())
    failed = F.broadcast(known.filter("error is not null").select("file").distinct())
    df, rejected, _ = keyed(stored.filter("error is null").join(failed, "file", "left_anti"), f"{batch}-{epoch}", batch_ts,
                            catalogue=xlsx.sheet_catalogue(known.join(failed, "file", "left_anti")))
    times = F.broadcast(files.select(F.col("path").alias(FILE_ORDER[1]), F.col("modificationTime").alias(FILE_ORDER[0])))
    df = df.withColumn("invoice_year", L.invoice_year("invoice_date")).join(times, F.col("source_file") == F.col(FILE_ORDER[1]))
    # keyed once: what has no year, the repeated keys and the accepted rows all read this
    df.write.option(*STAGE_CODEC).parquet(f"{stage}/keyed")
    df = spark.read.schema(df.schema).parquet(f"{stage}/keyed")
    with_year, no_year = split_missing_year(df, "invoice_year")
    place = ["source_file", "source_sheet", "row_no"]
    reason = rejected.columns[-1]
    rejected = (rejected.select(*place, F.col(reason).alias("reason"))
                .union(no_year.select(*place, F.lit("missing_year"))))
    together(spark, lambda: write_epoch(xlsx.error_rows(known), f"{side}/errors", epoch),
             lambda: write_epoch(rejected, f"{side}/rejected", epoch),
             lambda: import_batch(spark, with_year, epoch, target, f"{side}/quarantine", key, order=["source_sheet", "row_no"],
                                  stored=True))


def start_workbook_import(spark: SparkSession, landing: str, kind: str, target: str, side: str, checkpoint: str,
                          batch: str, batch_ts: str, available_now: bool = True, max_files_per_trigger: int = 100,
                          max_mb: float | None = 500.0):
    """Start the import of header or detail workbooks (``kind``) dropped below
    ``landing``; returns the StreamingQuery. ``max_files_per_trigger`` bounds
    a micro-batch and changes nothing about what is accepted."""
    stream = (spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.xls*")
              .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files_per_trigger).load(landing))

    def run(files: DataFrame, epoch: int) -> None:
        import_workbooks(files, epoch, kind, target, side, batch, batch_ts, max_mb)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
