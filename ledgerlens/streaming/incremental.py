"""Incremental import with Structured Streaming.

New files dropped in a landing folder are picked up by ``readStream``;
each micro-batch is imported by ``foreachBatch``: of rows with one key the
first is appended to the year-partitioned target and the others are
quarantined. "First" is by file time, file path and the caller's order
columns, over all files ever seen: inside a batch by a window, against
earlier batches by the keys already accepted. Files are taken in that order
and never split, so the accepted set does not depend on how many files a
micro-batch holds.

Exactly-once: every write goes to the partition of its micro-batch's id
(``import_epoch``) and replaces exactly that partition, and the known-key
lookup reads only earlier epochs, so a retried micro-batch reproduces the
same result instead of appending twice.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.dedup import quarantine_reasons
from ledgerlens.operators.joins import as_list
from ledgerlens.session import STAGE_CODEC, compilable_methods, path_exists, remove_path, scratch_path


FILE_ORDER = ["__file_time", "__file_path"]


def _known_keys(spark: SparkSession, batch: DataFrame, target: str, keys: list[str], epoch: int) -> DataFrame | None:
    if epoch == 0 or not path_exists(spark, target):
        return None
    # the columns' types are known: no file is opened for them
    schema = T.StructType([batch.schema[k] for k in keys]).add("import_epoch", T.LongType())
    return spark.read.schema(schema).parquet(target).filter(F.col("import_epoch") < epoch).select(*keys)


def write_epoch(df: DataFrame, path: str, epoch: int, by=()) -> None:
    """Write what the micro-batch has for the table at ``path`` into its own
    folder there, in place of what an earlier run of it wrote. The epoch is
    the folder's name and no column of the query, which thus stays the same
    from one micro-batch to the next, generated code included."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by)
     .parquet(f"{path.rstrip('/')}/import_epoch={epoch}"))


def together(spark: SparkSession, *writes) -> None:
    """Run writes that do not need each other at the same time."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]:
            done.result()


def import_batch(spark: SparkSession, batch: DataFrame, epoch: int, target: str, quarantine_path: str,
                 key, year: str = "invoice_year", order=(), stored: bool = False) -> None:
    """Import one micro-batch (with the ``FILE_ORDER`` columns). The split is
    computed once, staged, and written to both places; ``stored`` when the
    micro-batch is a stored table (see ``dedup.group_flags``)."""
    keys = as_list(key)
    reason = "quarantine_reason"
    split = quarantine_reasons(batch, keys, known_keys=_known_keys(spark, batch, target, keys, epoch), mode="keep_first",
                               order=[*FILE_ORDER, *as_list(order)], reason=reason, stored=stored)
    stage = scratch_path(spark, f"epoch-{epoch}-{uuid.uuid4().hex[:12]}")
    split = split.drop(*FILE_ORDER)
    with compilable_methods(spark):
        split.write.option(*STAGE_CODEC).parquet(stage)
    done = spark.read.schema(split.schema).parquet(stage)
    # by year: a file or few of each, which the next micro-batches read for their keys
    new = done.filter(F.col(reason).isNull()).drop(reason).hint("rebalance", year).sortWithinPartitions(year)
    together(spark, lambda: write_epoch(new, target, epoch, [year]),
             lambda: write_epoch(done.filter(F.col(reason).isNotNull()), quarantine_path, epoch))
    remove_path(spark, stage)


def start_incremental_import(spark: SparkSession, landing: str, schema, target: str, quarantine_path: str,
                             checkpoint: str, key, year: str = "invoice_year", fmt: str = "parquet",
                             available_now: bool = True, max_files_per_trigger: int | None = 1000, order=()):
    """Start the import stream; returns the StreamingQuery.

    ``max_files_per_trigger`` bounds a micro-batch, so a large backlog in
    the landing folder is imported as several epochs instead of one huge
    batch (``availableNow`` honours it); it does not change what is accepted.
    ``order`` names the columns that order the rows of one file."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # drops are sub-folders of the landing folder
    stream = reader.load(landing.rstrip("/") + "/*").select(
        "*", F.col("_metadata.file_modification_time").alias(FILE_ORDER[0]),
        F.col("_metadata.file_path").alias(FILE_ORDER[1]))

    def run(batch_df: DataFrame, epoch: int) -> None:
        import_batch(batch_df.sparkSession, batch_df, epoch, target, quarantine_path, key, year, order)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
