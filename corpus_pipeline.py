"""A training-data pipeline over `documents`: stages that each take what the one before kept.

language         documents without a known language go
near_duplicates  one document of each class of near copies stays, that of the least doc_id
benchmark        documents that share a window of words with a benchmark item go
secrets          secrets in the texts are masked
tokens           the texts are encoded, and decoded again"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, langid, neardup, secrets
from tidemark.llm.common import stored

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts, and texts without letters, have no language and go. Repeated rows share
    their fate. Without labelled rows there is no language to know, and every row goes."""
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated rows are one class. Among equal least doc_ids (a null is least) the text of the least
    digest stays; an empty text is a class with those of its own doc_id only."""
    return neardup.without_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts have no words and stay, and so does everything where no item has words.
    Repeated rows share their fate."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Row by row; a null text stays null, an empty one empty. Spans that overlap are one mask."""
    return secrets.mask_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Row by row; a null text is empty and has no ids."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", mask),
    ("tokens", tokens),
]

# Near-duplicate classes are connected components of a similarity join, and the tokens are those of
# a vocabulary file: neither is a DuckDB query. tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
