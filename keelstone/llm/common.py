"""Helpers shared by the training-data operators.

Shared storage
    ``staged`` cuts lineage by writing a table below ``spark.checkpoint.dir`` (the folder the
    cluster names), or below the warehouse where that is unset.

Flat text
    ``flat`` exposes an Arrow string column as one byte array plus offsets, and ``slices`` walks it
    in bounded pieces, so that numpy works on a few MB at a time whatever the batch holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.sources.shared import shared_dir

#: Bytes of text that numpy code holds at once (one longer document is taken alone).
SLICE_BYTES = 1 << 19

#: ``[\x20\x09-\x0D]``, the bytes between words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: a cut in lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_bound(count: int, wanted: int) -> int:
    """The 64-bit hash that about four times ``wanted`` of ``count`` rows are at or below.

    The ``wanted`` rows of least hash are among these, so that finding them sorts a few rows and not what
    every task keeps of its own.
    """
    return min((1 << 63) - 1, int((1 << 64) * 4 * wanted / max(1, count)) - (1 << 63))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges (i, j) of documents that hold about ``limit`` bytes together, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of the string column."""
    for batch in batches:
        for i, j in slices(flat(batch.column(column))[1], limit):
            yield batch.slice(i, j - i)
            pa.default_memory_pool().release_unused()


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each document, with a closing entry) of the words of flat texts.

    ``offsets`` count from 0 in ``data``; a word never crosses a document's border.
    """
    inside = ~SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    if len(data):
        border = offsets[(offsets > 0) & (offsets < len(data))]
        starts[border] = inside[border]
        ends[border - 1] = inside[border - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): connected components, each named by its smallest node.

    Large-star and small-star steps alternate until the edges are stars around the smallest node.
    Every step is two aggregations and two joins.  Minima are combined before the shuffle; in the joins a node
    with very many neighbours is a skewed key, whose rows adaptive execution splits among tasks
    (``spark.sql.adaptive.skewJoin``), as the other side has one row for it.
    """

    def nearest(pairs: DataFrame) -> DataFrame:
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(low, "u").withColumn("m", F.least("m", "u"))

    def state(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
        return row["n"], row["h"]

    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, before = staged(e, "cc"), None
    while (now := state(e)) != before:
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = nearest(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        e = staged(small.where("u <> v").distinct(), "cc")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
