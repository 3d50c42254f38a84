"""The registered queries of this package: name -> (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe, decontaminate, fingerprints, infill, langid, licenses, neardup, packed_ids, repeats, secrets, shards, trie, warc
)

from tidemark.llm.oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(table(spark, sf_dir, "documents"), shards=40)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_ids.encoded_documents(table(spark, sf_dir, "documents"), path, end_id=1)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_warc, op2_secrets, op3_sharding, op4_near_duplicates, op5_packed_ids, op6_repeats,
              op7_language, op8_fingerprints, op9_decontamination, op10_byte_bpe, op11_prefix_trie,
              op12_licenses, op13_fill_in_middle)
}
