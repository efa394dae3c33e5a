"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as
Parquet in the shared folder and reads it again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffinlens.llm import bpe, lines, quality, simhash, tiling
from tiffinlens.llm.staging import staged

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled rows that are not held out, finds good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = quality.train(docs, labels)
    return quality.with_quality(docs, network, "__score").where("__score >= 0.5").drop("__score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines; n_chars follows the text."""
    cleaned = lines.drop_boilerplate(docs, host="source")
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, ids, and the digest of the decoded bytes."""
    columns = [c for c in ("doc_id", "lang", "source", "n_chars") if c in docs.columns]
    return bpe.encoded(
        docs,
        public_tokenizers.path(RANK_FILE),
        public_tokenizers.PATTERN,
        columns,
        ("ids", "decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", bpe_encoding),
]

# The classifier, the fingerprints' links, tiles and merges have no SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = staged(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
