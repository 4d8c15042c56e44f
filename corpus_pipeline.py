"""From raw documents to encoded training text, in stages that each read what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelbench.llm import bpe, jaccard, language, lines, mixing
from labelbench.shared import cut

MIX_WEIGHTS = (1, 2, 3)
VOCABULARY = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out texts in no learned language, ambiguous ones, and those without a letter."""
    codes = language.trained(docs.where(~language.is_held_out()), bounded=True)
    return language.in_a_language(docs, codes)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that at least ten documents share; n_chars follows the text."""
    kept = lines.drop_repeated_lines(docs, min_docs=10, min_chars=1)
    n_chars = F.char_length("text").cast(kept.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest doc_id stays."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mixed(docs, cycle=MIX_WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row, as little-endian 32-bit integers, and the text they decode to."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("BPE", encode),
]

# Fitted language models and a fixed vocabulary decide on rows, so no SQL gives them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
