"""Parquet tables, and the labelled text samples built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelbench.functions.text import count_char, count_matches

# Labelled doc_ids that may be sent to the scan of the texts, 8 bytes each.
SENT_LABELS = 2_000_000
TEXT_FEATURES = ["f_chars", "f_spaces", "f_newlines", "f_upper", "f_punct"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_samples(spark: SparkSession, folder: str, sent_labels: int = SENT_LABELS) -> DataFrame:
    """Labelled documents: ``doc_id``, ``label`` and five measures of the whole text.

    The measures are taken before the join, so the shuffle moves five numbers per document and
    never a text. Where there are at most ``sent_labels`` labels, their doc_ids go to the scan, and only
    labelled texts are measured; beyond that all are.
    """
    labels = (
        table(spark, folder, "labels")
        .where(F.col("quality").isNotNull())
        .select("doc_id", F.col("quality").cast("double").alias("label"))
    )
    documents = table(spark, folder, "documents").where(F.col("text").isNotNull() & F.col("n_chars").isNotNull())
    if labels.count() <= sent_labels:
        documents = documents.join(F.broadcast(labels.select("doc_id")), "doc_id", "left_semi")
    measures = documents.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("f_chars"),
        count_char("text", " ").alias("f_spaces"),
        count_char("text", "\n").alias("f_newlines"),
        count_matches("text", "[A-Z]").alias("f_upper"),
        count_matches("text", "[.,;:!?]").alias("f_punct"),
    )
    return measures.join(labels, "doc_id").select("doc_id", "label", *TEXT_FEATURES)
