"""The corpus pipeline: quality, near duplicates, decontamination, surrogates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.llm import decontaminate, ngram_join, packing, pii, quality
from cityflow.llm.common import broadcast_small, saved, table
from cityflow.llm.queries import quality_labels


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects, a score under 0.5."""
    labels = quality_labels(spark, sf_dir)
    model = quality.fit(quality.measure(docs), labels)
    kept = quality.with_stats(docs.select(F.struct("*").alias("row"), "text"))
    return kept.where(model.score() >= 0.5).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates."""
    groups = ngram_join.jaccard_components(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id")
    return docs.join(broadcast_small(gone, "pipeline-gone"), "doc_id", "left_anti").select(
        docs.columns
    )


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of whose words benchmark phrases make up 5 % or more."""
    spans = decontaminate.removal_spans(
        docs.withColumn("row", F.struct("*")), table(spark, sf_dir, "benchmark"), keep="row"
    )
    return decontaminate.report(spans).where("NOT contaminated").select("row.*")


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and secrets by surrogates."""
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", n_chars).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 token ids."""
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", without_pii),
    ("packing", packed),
]

# Trained scores and tokenizer ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
