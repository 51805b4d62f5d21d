"""Pipeline stages: each takes ``(spark, docs, sf_dir)`` and applies one
operator's decisions to the rows of ``docs`` (columns of ``documents``; rows
may repeat, ids and texts may be null, an empty table stays empty)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, language, mixing, ngram_join, sharding
from ledgerlens.llm.common import Stages, read_table

#: near duplicates: five-word shingles, similarity 0.8
NEAR_WORDS, NEAR_NUM, NEAR_DEN = 5, 80, 100
SHARDS = 40


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The rows as one struct ``whole`` beside the named columns, so that a
    stage's own columns clash with no other column of the documents."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), *columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language: null texts and texts
    without a letter. The model is trained on the labelled rows of ``docs``
    that are not held out; without any, every row would be undetermined, so
    all texts with a letter stay."""
    langs, loglik = language.train(docs.where(~language.held_out()))
    if not langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language.identify(_packed(docs, "text"), langs, loglik)
    return judged.where(F.col("lang_pred") != language.UNDETERMINED).select("whole.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked texts, that of the smallest id.
    Rows are linked one by one: an id that comes with several texts keeps each
    text that links with no other, and of equal rows one stays. Blank texts
    and rows without an id link with nothing and stay."""
    st = Stages(spark, "near-duplicates")
    rows = st.write(_packed(docs.where("doc_id is not null")).withColumn("rid", F.monotonically_increasing_id()), "rows")
    groups = ngram_join.ngram_jaccard_join(rows.select("rid", "whole.text"), id_col="rid", n=NEAR_WORDS, num=NEAR_NUM, den=NEAR_DEN)
    groups = groups.select(F.col("doc_id").alias("rid"), "component_id")
    stay = (groups.join(rows.select("rid", "whole.doc_id"), "rid").groupBy("component_id")
            .agg(F.min(F.struct("doc_id", "rid")).alias("least")).select(F.col("least.rid").alias("rid")))
    return rows.join(stay, "rid", "left_semi").select("whole.*").union(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources: a document comes as many times (0 to 2) as the mix
    takes it; the last one of a source is taken whole or not at all."""
    taken = mixing.mix(docs, Stages(spark, "mixing"), cut_last=False).where("taken > 0")
    copies = taken.select(
        F.col("doc_id").alias("t_id"), F.col("th").alias("t_th"), (F.col("taken") / F.col("size")).cast("int").alias("times"),
        F.row_number().over(Window.partitionBy("doc_id", "th").orderBy(F.desc("taken"))).alias("t_nth"))
    same = Window.partitionBy("doc_id", "th").orderBy(F.xxhash64("whole"))
    rows = (_packed(docs, "doc_id", "text").select("whole", "doc_id", F.xxhash64("text").alias("th"))
            .withColumn("nth", F.row_number().over(same)))
    mixed = rows.join(copies, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("th") == F.col("t_th"))
                      & (F.col("nth") == F.col("t_nth")))
    return mixed.select("whole", F.explode(F.sequence(F.lit(1), "times"))).select("whole.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``shard`` and ``slot`` (columns of these names are
    replaced)."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    out = sharding.shard(docs, Stages(spark, "sharding"), shards=SHARDS, keep=kept)
    return out.select(*kept, "shard", "slot")
