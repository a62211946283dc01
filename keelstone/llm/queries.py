"""The operators as queries over whole tables, in the form their result contracts ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.llm import bpe, embedding_dedup, fingerprint, language, mixing, quality, sharding, simhash, sql, substring_dedup, suffix_dedup
from keelstone.llm.common import documents


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(documents(spark, sf_dir), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, rules)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(documents(spark, sf_dir)))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_suffix_dedup, op2_substring_dedup, op3_sharding, op4_language_id, op5_quality, op6_embedding_dedup, op7_simhash, op8_byte_bpe, op9_fingerprint, op10_mixing)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": sql.SUBSTRING_DEDUP,
        "op6_embedding_dedup": sql.EMBEDDING_DEDUP,
        "op10_mixing": sql.MIXING,
    }
