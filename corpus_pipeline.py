"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and hands what it
reads back to the next stage, so a lost executor costs the running stage only. All stages but the last return the columns of
``documents``.

Defined cases: each stage handles null and empty texts, null ids, repeated rows and empty tables as its operator documents; a
document whose text is null or empty passes the quality stage by its score like any other, and near_duplicates keeps one of all
documents without words. Rows are told apart by doc_id and text, so rows that share a doc_id, or have none, are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import bpe, decontam, linededup, neardup, quality
from fleetscope.llm.common import durable, free_name, table, text_digest


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose quality score is below 0.3; learns as op7 does."""
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    whole = docs.select("text", F.struct("*").alias("row"))
    return quality.score(whole, rules).filter("score >= 0.3").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near duplicates: the smallest by (doc_id, md5 of the text), a null doc_id last."""
    id_, digest = free_name(docs, "kept_id"), free_name(docs, "kept_md5")
    kept = neardup.representatives(docs).toDF(id_, digest)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & text_digest().eqNullSafe(F.col(digest))
    left = docs.join(kept, same, "left_semi")
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1):
        # rows equal in doc_id and text are in one class: the smallest by all columns stays
        left = left.groupBy("doc_id", "text").agg(F.min(F.struct("*")).alias("row")).select("row.*")
    return left


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document has, in runs of units; n_chars follows the text."""
    cleaned = linededup.clean(docs)
    report = cleaned.columns[-1]
    n_chars = F.when(F.size(f"{report}.removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which 5 % or more of the words lie in windows of the benchmark."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    id_, digest = free_name(docs, "bad_id"), free_name(docs, "bad_md5")
    bad = found.select("doc_id", "text_md5").distinct().toDF(id_, digest)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (text_digest() == F.col(digest))
    return docs.join(bad, same, "left_anti")


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode what is left: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.digests(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("byte_bpe", encode_bytes),
]

#: No stage but substring_dedup and decontaminate can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
