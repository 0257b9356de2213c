"""The corpus pipeline: stages over the documents table, each written as Parquet and read again as the next one's input.

All stages keep the columns of their documents (but the last, which returns its own), whatever other columns there are; texts are worked
on whole, however long; rows with null or repeated ids are rows like others, as no stage goes by the id alone; an empty table gives an
empty one. What each does with null and empty texts, ties and repeated rows is said at the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varideck.llm import bpe, lsa, minhash, pii, quality
from varideck.llm.common import free_name, small_batches, stored, table

#: A document with a lower quality score goes.
KEEP = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject: those with a score of at least KEEP. Null and empty texts have the score of the bias
    alone; equal texts have equal scores, so repeated rows stay or go together. Without labels of both classes nothing is rejected."""
    small_batches(spark)
    model, score = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")), free_name(docs, "_score")
    if not model.weights.any():
        return docs
    return quality.with_score(docs, model, out=score).filter(F.col(score) >= KEEP).drop(score)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id (null last) of each group of near-duplicates, on five-word shingles at 0.8. Of rows with the same
    id, or of several without one, any one stays, the same in all runs over the same files. Null and empty texts, and those without
    words, are near-duplicates of nothing and all stay."""
    small_batches(spark)
    row = free_name(docs, "_row")
    # Stored, so that the rows' numbers stay what they are.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    groups = minhash.near_duplicates(numbered.select(row, "text"), key=row, words=5, percent=80)
    least = numbered.select("doc_id", row).join(groups.select(row, "component_id"), row).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("_least"))
    return numbered.join(least.select(F.col(f"_least.{row}").alias(row)), row, "left_semi").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. The text alone decides, so rows go by its digest, whether their ids repeat or are null; repeated
    rows stay or go together. Null and empty texts are clean; an empty benchmark leaves all."""
    small_batches(spark)
    name = free_name(docs, "_digest")
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias(name)
    flagged = lsa.contaminated(docs.select(digest, "text"), table(spark, sf_dir, "benchmark", "item_id", "text"), key=name).filter("contaminated").select(name).distinct()
    return docs.withColumn(name, digest).join(stored(flagged, "contaminated"), name, "left_anti").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind, and n_chars of the new text. Null texts stay null, texts without
    personal data stay as they are; equal texts give equal ones."""
    small_batches(spark)
    return pii.redacted(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and their number for all documents; null and empty texts have no ids."""
    small_batches(spark)
    return bpe.bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: The trained classifier, the sketches and the latent space aren't SQL-expressible; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
