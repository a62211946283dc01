"""From raw documents to token ids in five stages.

A stage is a function of (spark, docs, sf_dir).  All but the last return the columns of ``documents``.
``sf_dir`` holds the ``labels`` table that the quality stage learns from.

Defined results: an empty table gives an empty result of the same columns at every stage.  The quality stage scores
a null text as an empty one.  The near-duplicate stage keeps rows without an id; rows that share an id are told
apart by their texts, and of equal rows one stays.  The passage stage keeps rows without an id whole.  The mix has
a source of its own for null sources, and leaves out texts without words, as it takes words; so the result has no
row for them.  Columns beyond those of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.llm import bpe, mixing, quality, simhash, suffix_dedup
from keelstone.llm.common import documents, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept, unchanged."""
    return quality.accepted(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles or more, that of smallest id; documents without an id stay."""
    found = staged(simhash.similar(docs), "similar")
    again = found.where("doc_id is not null").groupBy("doc_id", "text_key").count().where("count > 1")
    leave = found.where("doc_id <> component_id or text_key <> head_key").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    kept = docs.join(leave, (docs["doc_id"] == leave["gone_id"]) & (F.xxhash64(docs["text"]) == leave["gone_key"]), "left_anti")
    if again.isEmpty():
        return kept
    return kept.where("doc_id is null").unionByName(kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))


def passage_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one has; a character cut in two becomes U+FFFD."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    kept = suffix_dedup.remove_repeats(docs, carry=carry).withColumn("text", F.make_valid_utf8(F.col("kept").cast("string")))
    kept = kept.withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(*[F.col(f.name).cast(f.dataType) for f in docs.schema])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passes over documents, and parts of them, that the mix takes."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row (little-endian unsigned 32-bit integers), with digests."""
    encoded = bpe.encode(docs, carry=("doc_id", "source"))
    ids = F.col("ids")
    return encoded.select(
        "doc_id", "source", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), ids,
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", passage_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

#: The rules, fingerprints and suffix order have no SQL form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
