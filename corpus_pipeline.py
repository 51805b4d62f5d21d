"""Training-data pipeline: language ID, near-duplicate removal, benchmark
decontamination, source mixing, sharding, each stage written as Parquet and
read again as the next one's input.

``run`` starts from ``documents``. ``ORACLE_SQL`` is None: the mixture model
of the first stage is not SQL, so tests compare with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import stages
from ledgerlens.llm.common import Stages, read_table

STAGES = [
    ("language_id", stages.language_id),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("benchmark_decontamination", stages.decontamination),
    ("source_mixing", stages.source_mixing),
    ("sharding", stages.sharded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    written = Stages(spark, "pipeline")
    for name, stage in STAGES:
        out = written.write(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            written.drop(docs)
        docs = out
    return docs
