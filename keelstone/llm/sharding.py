"""Sharding by minimax contiguous partition.

Documents with equal texts form one atomic group.  Groups are ordered by the hash of their text,
and a run of neighbouring groups goes to each shard.  The capacity is the smallest one that a greedy
left-to-right packing can meet with the given number of shards, found by binary search.

The driver never sees the groups.  It sees *units*: ranges of the order with their total size, at
first ``2**12`` of them.  Packing units as if they were atomic bounds the capacity from above, packing
them as if they were divisible bounds it from below; the units at the cuts of both packings (a few for each shard) are
split further, eight bits at a time, until both bounds meet.  That capacity is the exact optimum over the groups.  Where
it leaves freedom (one group larger than a fair share), cuts go next to the fair share.

Defined results: a null text has no bytes and counts as an empty one; repeated rows each take a
slot; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import staged

FIRST_BITS, MORE_BITS = 12, 8


def _cuts(sums: np.ndarray, capacity: int, shards: int, divisible: np.ndarray | None = None) -> list[float] | None:
    """Positions (in size) at which a greedy packing closes each shard, or None if shards run out."""
    ends = np.concatenate([[0], np.cumsum(sums)])
    total, at, out = ends[-1], 0, []
    for _ in range(shards):
        if at >= total:
            break
        i = int(np.searchsorted(ends, at + capacity, "right")) - 1
        reached = int(ends[i])
        if i < len(sums) and divisible is not None and divisible[i]:
            reached = at + capacity
        if reached <= at:
            return None
        at = min(reached, int(total))
        out.append(at)
    return out if at >= total else None


def _smallest(sums: np.ndarray, shards: int, divisible: np.ndarray | None = None) -> int:
    """The smallest capacity for which ``_cuts`` succeeds."""
    low, high = max(1, -(-int(sums.sum()) // shards)), max(1, int(sums.sum()))
    while low < high:
        middle = (low + high) // 2
        if _cuts(sums, middle, shards, divisible) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _units(groups: DataFrame, bits: int, within: list[int] | None = None, parent_bits: int = 0) -> pd.DataFrame:
    if within is not None:
        groups = groups.where(F.shiftright("key", 64 - parent_bits).isin(within))
    unit = F.shiftright("key", 64 - bits) if bits < 64 else F.col("key")
    out = groups.groupBy(unit.alias("unit")).agg(F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high"))
    return out.toPandas().assign(bits=bits)


def cut_keys(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """(keys at which the 2nd, 3rd ... shard begins, capacity) for ``groups`` (key, size)."""
    units = _units(groups, FIRST_BITS).sort_values("low", ignore_index=True)
    if units.empty:
        return [], 0
    while True:
        sums = units["size"].to_numpy(np.int64)
        divisible = (units["low"] != units["high"]).to_numpy()
        upper, lower = _smallest(sums, shards), _smallest(sums, shards, divisible)
        if upper == lower:
            break
        ends = np.cumsum(sums)
        split = np.zeros(len(units) + 1, bool)
        # at least one cut at the lower capacity is within a unit, else that capacity would do for whole units
        for at in _cuts(sums, lower, shards, divisible) + _cuts(sums, upper, shards):
            unit = int(np.searchsorted(ends, at, "left"))
            split[unit : unit + 2] = True
        split = split[:-1] & divisible
        kept, parts = units[~split], []
        for bits, some in units[split].groupby("bits"):
            parts.append(_units(groups, min(64, int(bits) + MORE_BITS), some["unit"].tolist(), int(bits)))
        units = pd.concat([kept, *parts]).sort_values("low", ignore_index=True)
    return _fair(units, upper, shards), upper


def _fair(units: pd.DataFrame, capacity: int, shards: int) -> list[int]:
    """Cuts within ``capacity`` that stay next to the fair share of what is left."""
    sums = units["size"].to_numpy(np.int64)
    ends = np.concatenate([[0], np.cumsum(sums)])
    total = int(ends[-1])
    latest = _cuts(sums[::-1], capacity, shards)
    # a cut before earliest[j] would leave more than the shards after it can take
    earliest = [0] * shards
    for j, back in enumerate(latest, 1):
        if j < shards:
            earliest[shards - j - 1] = total - back
    at, keys = 0, []
    for j in range(shards - 1):
        want = at + (total - at) / (shards - j)
        furthest = int(np.searchsorted(ends, at + capacity, "right")) - 1
        first = max(int(np.searchsorted(ends, earliest[j], "left")), int(np.searchsorted(ends, at, "left")))
        i = int(np.searchsorted(ends, want))
        i -= i > 0 and want - ends[i - 1] < ends[min(i, len(ends) - 1)] - want
        i = min(max(i, first), furthest)
        at = int(ends[i])
        keys.append(int(units["low"].iloc[i]) if i < len(units) else None)
    return [k for k in keys if k is not None]


def shard(docs: DataFrame, shards: int = 8, text: str = "text", id_col: str = "doc_id", slot_rows: int = 1_000_000) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row.

    ``slot`` numbers each shard's rows without gaps; it is counted within hash buckets of about
    ``slot_rows`` rows at most, whose offsets come from their counts.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    thin = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("key")
    )
    thin = staged(thin, "shard")
    keys, _ = cut_keys(thin, shards)
    number: Column = F.lit(0)
    for k in keys:
        number = number + (F.col("key") >= F.lit(k)).cast("int")
    buckets = 64 * (1 + thin.count() // (64 * slot_rows))
    dealt = thin.withColumn("shard", number).withColumn("bucket", F.pmod(F.xxhash64("id", "key"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("shard", "bucket").count()
    before = F.expr("sum(count) over (partition by shard order by bucket rows between unbounded preceding and current row) - count")
    offsets = counts.select("shard", "bucket", before.alias("before"))
    row = F.expr("row_number() over (partition by shard, bucket order by id, key)")
    # shards x buckets rows; Spark chooses the join by that size
    return dealt.withColumn("row", row).join(offsets, ["shard", "bucket"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("before") + F.col("row") - 1).alias("slot")
    )
