"""A corpus pipeline: documents in, token ids out.

Each stage calls one operator of ``acct_health.llm`` on all that the stage before it kept, and is
written as Parquet in the shared folder and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acct_health.llm.bpe import round_trip
from acct_health.llm.common import read_table, written
from acct_health.llm.decontamination import drop_contaminated
from acct_health.llm.language import drop_undetermined
from acct_health.llm.pii import mask_documents
from acct_health.llm.simhash import drop_near_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those of null text or without a letter go."""
    return drop_undetermined(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies: 3-word shingles, 3 bits."""
    return drop_near_copies(docs, shingle=3, distance=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the personal data in their texts masked; n_chars is that of the new text."""
    return mask_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    return round_trip(docs, remembered=100_000)  # workers share the executor with a heap that earlier stages have grown


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Learned models, XXH64 fingerprints and BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
