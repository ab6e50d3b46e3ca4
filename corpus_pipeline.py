"""The corpus pipeline: quality rules, line dedup, near-dedup, source mixing, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet into the shared checkpoint folder and hands it, reread, to
the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.llm import bpe, line_dedup, minhash, mixing, quality
from agroclim.llm.common import stored, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled rule rejects go."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all documents but the first; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs).toDF(*docs.columns, "__n_lines", "__n_dropped")
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("__n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n_chars)
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (0.8 or more) the smallest doc_id stays."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or thinned by source."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and the text decoded from them."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near dedup", near_dedup),
    ("source mixing", mix_sources),
    ("byte-level BPE", encode),
]

# Learned thresholds and merges of byte pairs are beyond SQL; the tests hold run()
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
