"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprints are made in Arrow batches.  Each of the ``2**(radius+1) - 1`` masks of a covering
family keeps the bits whose code word is odd against the mask's vector; any ``radius`` code words
leave at least one vector orthogonal to all of them, so every pair within the radius agrees under
some mask.  Only distinct fingerprints are compared.  A bucket that holds more than ``bucket_rows``
of them is dealt again under the union of its mask with each mask of a second, third ... family: a
pair still agrees under one of these, so nothing is lost, and the bits left free shrink quickly.  From the
fourth family on (where about one bit in sixteen is free) buckets are compared whole, whatever they hold.
Within a bucket the linked fingerprints are joined by as few links as connect them, never by all pairs.

``near_duplicates`` links texts by the distance of their 64-bit fingerprints.  ``similar`` links them by the
Jaccard similarity of their sets of shingles: a fingerprint of ``PARTS * PART_BITS`` bits is covered part by
part, and what it brings together is checked exactly.  By pigeonhole every pair within
``PARTS * (radius + 1) - 1`` bits collides; pairs at the least similarity are further apart than that, and
meet since each mask of each part is another chance: 0.993 of those at exactly 0.8, if equal in size.

Defined results: a null or empty text has no words and fingerprint zero, which links like any
other; repeated rows keep one result each; null ids keep their rows; rows that share an id are one document to
``near_duplicates``, which links their texts, and several to ``similar``; an empty table gives none.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import components, flat, slices, staged, words

BITS = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(data: np.ndarray, offsets: np.ndarray, shingle: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(hashes of shingles, where those of each document with any begin, which documents these are, all documents)."""
    start, end, first = words(data, offsets)
    n_words = np.diff(first)
    if not len(start):
        return np.zeros(0, "<u8"), np.zeros(0, np.int64), np.zeros(0, np.int64), len(n_words)
    lengths = end - start
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    inside = np.repeat(start - at[:-1], lengths)
    text = np.full(at[-1], 0x20, np.uint8)
    place = np.arange(len(inside)) + np.repeat(np.arange(len(start)), lengths)
    text[place] = _LOWER[data[place + inside]]
    n_shingles = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    some = np.flatnonzero(n_shingles)
    counts = n_shingles[some]
    begins = np.cumsum(counts) - counts
    w = np.arange(counts.sum()) + np.repeat(first[some] - begins, counts)
    last = w + np.repeat(np.minimum(n_words[some], shingle) - 1, counts)
    text, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[i:j], seed) for i, j in zip(at[w].tolist(), (at[last + 1] - 1).tolist(), strict=True)), "<u8", len(w))
    return hashes, begins, some, len(n_words)


def _slice_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int, seed: int) -> np.ndarray:
    hashes, begins, some, n = shingles(data, offsets, shingle, seed)
    out = np.zeros(n, np.uint64)
    if not len(some):
        return out
    counts = np.diff(np.append(begins, len(hashes)))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    out[some] = np.packbits(2 * ones > counts[:, None], axis=1).view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp long): the SimHash of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            parts = [_slice_fingerprints(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shingle, seed) for i, j in slices(offsets)]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def covering_masks(radius: int, seed: int, bits: int = BITS, always: int = 0) -> list[int]:
    """Masks (as signed 64-bit integers) such that any ``radius`` of the first ``bits`` are all free under one of them."""
    size = 1 << (radius + 1)
    codes = [1 + i % (size - 1) for i in range(bits)]
    random.Random(seed).shuffle(codes)
    masks = [always | sum(1 << i for i, c in enumerate(codes) if (c & v).bit_count() & 1) for v in range(1, size)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _spanning(near: Callable[[int, np.ndarray], np.ndarray], ids: np.ndarray) -> list[tuple[int, int]]:
    """Links that join each linked set of rows, one fewer than its rows; ``near``: which rows of some are near one.

    Each set is walked from its smallest id, so that the buckets of a large group mostly give the same few centres.
    """
    edges, left = [], np.argsort(ids, kind="stable")
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            close = near(x, left)
            if close.any():
                found = left[close].tolist()
                queue += found
                left = left[~close]
                edges += [(int(ids[x]), int(ids[y])) for y in found]
    return edges


def links(distinct: DataFrame, radius: int = 3, bucket_rows: int = 2000, seed: int = 7, bits: int = BITS, always: int = 0, far_radius: int = 64) -> DataFrame:
    """(a, b): edges that connect, within ``radius``, the fingerprints of ``distinct`` (fp, rep).

    The edges span the same components as all linked pairs do.  Only the first ``bits`` of a fingerprint are
    covered; those of ``always`` must be equal.  If ``distinct`` has a column ``far`` of further bits, all that
    share a bucket and differ in at most ``far_radius`` bits of both columns are linked.
    """
    rest = ["fp", "rep", *(["far"] if "far" in distinct.columns else [])]

    def compare(cap: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[pd.DataFrame] = []
            spilling = None

            def keys(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
                mask = frame["mask"].to_numpy()
                return mask, frame["fp"].to_numpy() & mask

            def close(frame: pd.DataFrame) -> list[tuple[int, int]]:
                fp, ids = frame["fp"].to_numpy().view(np.uint64), frame["rep"].to_numpy()
                far = frame["far"].to_numpy().view(np.uint64) if "far" in rest else None

                def near(x, y):
                    apart = np.bitwise_count(fp[x] ^ fp[y])
                    return apart <= radius if far is None else apart + np.bitwise_count(far[x] ^ far[y]) <= far_radius

                mask, key = keys(frame)
                edge = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]), [True]]))
                size = np.diff(edge)
                two = edge[:-1][size == 2]
                two = two[near(two, two + 1)]
                out = list(zip(np.minimum(ids[two], ids[two + 1]).tolist(), np.maximum(ids[two], ids[two + 1]).tolist(), strict=True))
                for i, n in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
                    out += _spanning(lambda x, y, i=i: near(i + x, i + y), ids[i : i + n])
                return out

            def rows(edges: list[tuple[int, int]]) -> pd.DataFrame:
                a, b = zip(*edges, strict=True) if edges else ((), ())
                return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64), "far": np.zeros(len(a), np.int64), "mask": np.zeros(len(a), np.int64), "over": False})

            def over(frame: pd.DataFrame) -> pd.DataFrame:
                return pd.DataFrame({"a": frame["fp"], "b": frame["rep"], "far": frame["far"] if "far" in rest else 0, "mask": frame["mask"], "over": True})

            for frame in frames:
                if spilling is not None:
                    mask, key = keys(frame)
                    same = (mask == spilling[0]) & (key == spilling[1])
                    yield over(frame[same])
                    frame = frame[~same]
                    if frame.empty:
                        continue
                    spilling = None
                frame = pd.concat([*held, frame], ignore_index=True)
                if frame.empty:
                    continue
                mask, key = keys(frame)
                edge = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]))
                size = np.diff(np.append(edge, len(frame)))
                big = np.repeat(size > cap, size)
                last = np.zeros(len(frame), bool)
                last[edge[-1] :] = True
                yield over(frame[big])
                if size[-1] > cap:
                    spilling, held = (mask[-1], key[-1]), []
                else:
                    held = [frame[last]]
                done = frame[~big & ~last]
                if len(done):
                    yield rows(close(done))
            if held:
                yield rows(close(held[0]))

        return run

    todo = distinct.select(*rest, F.lit(0).cast("long").alias("mask"))
    found, level = None, 0
    while True:
        masks = F.explode(F.array(*[F.lit(m).cast("long") for m in covering_masks(radius, seed + level, bits, always)]))
        keyed = todo.select(*rest, "mask", masks.alias("more")).select(*rest, F.col("mask").bitwiseOR(F.col("more")).alias("mask"))
        if level:
            keyed = keyed.distinct()
        key = F.col("fp").bitwiseAND(F.col("mask"))
        dealt = keyed.repartition("mask", key).sortWithinPartitions("mask", key)
        # after three families few bits are free and a bucket is small by itself
        out = staged(dealt.mapInPandas(compare(bucket_rows if level < 3 else 1 << 40), "a long, b long, far long, mask long, over boolean"), "simhash")
        edges = out.where("not over").select("a", "b")
        found = edges if found is None else found.unionByName(edges)
        again = {"fp": F.col("a"), "rep": F.col("b"), "far": F.col("far")}
        todo = out.where("over").select(*[again[c].alias(c) for c in rest], "mask")
        level += 1
        if todo.isEmpty():
            return found.distinct()


def near_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, radius: int = 3, bucket_rows: int = 2000
) -> DataFrame:
    """(id, fingerprint, component_id): each document's fingerprint and the smallest id it is linked with.

    ``id_col`` must be an integer column; rows without an id form no links and keep a null component.
    """
    prints = staged(fingerprints(docs, text, id_col, shingle), "fp")
    distinct = staged(prints.where("id is not null").groupBy("fp").agg(F.min("id").cast("long").alias("rep")), "fpd")
    found = components(links(distinct, radius, bucket_rows))
    named = distinct.join(found, distinct["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = prints.join(named, "fp", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


#: The wide fingerprint of ``similar``: parts that are covered one by one, and further bits that rule out chance.
PARTS, PART_BITS, FAR_BITS = 12, 36, 86
_WORDS = -(-(PARTS * PART_BITS + FAR_BITS) // 16)

#: Bits in which two sets that share a bucket may differ: of one part and the further bits, and of all.  Each bit differs
#: with probability 0.15 at similarity 0.8, so these are 3.7 and 4 standard deviations above what is expected there.
NEAR_RADIUS, WIDE_RADIUS = 29, 113

#: Shingles that one task compares with as many others.
CROWD = 2_000_000


def _sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(different shingle hashes, sorted in each document; offsets of the documents)."""
    hashes, begins, some, n = shingles(data, offsets, shingle, 42)
    doc = np.repeat(some, np.diff(np.append(begins, len(hashes))))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(n + 1))


_NIBBLES = np.uint64(0x000F000F000F000F)
_CHUNK = 4096


def _wide(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bits of the wide SimHash of each set, one row for each; zeros for a set without shingles.

    A shingle has one of 16 evenly spaced weights for each bit, so that small sets have few ties.  Four weights are
    summed at once in the quarters of a word, for up to ``_CHUNK`` shingles, which can't overflow.
    """
    size = np.diff(at)
    some = np.flatnonzero(size)
    out = np.zeros((len(size), _WORDS, 4, 4), bool)
    if len(some):
        chunks = -(-size[some] // _CHUNK)
        own = np.cumsum(chunks) - chunks
        begin = np.repeat(at[some], chunks) + _CHUNK * (np.arange(chunks.sum()) - np.repeat(own, chunks))
        for k in range(_WORDS):
            x = (hashes + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            for i in range(4):
                sums = np.add.reduceat(x >> np.uint64(4 * i) & _NIBBLES, begin).view("<u2").reshape(-1, 4)
                out[some, k, i] = 2 * np.add.reduceat(sums, own, axis=0, dtype=np.int64) > 15 * size[some, None]
    return out.reshape(len(out), -1)


def _longs(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit integers, the last one filled up with zeros."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    full = np.zeros((*packed.shape[:-1], -(-packed.shape[-1] // 8) * 8), np.uint8)
    full[..., : packed.shape[-1]] = packed
    return full.view("<i8")


def _parts(wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a word for each part: its bits, its number, the first further bits; a word of the other further bits)."""
    bits = np.unpackbits(np.ascontiguousarray(wide).view(np.uint8), axis=1, bitorder="little")
    whole, here = PARTS * PART_BITS, 58 - PART_BITS
    low = np.zeros((len(bits), PARTS, 64), np.uint8)
    low[:, :, :PART_BITS] = bits[:, :whole].reshape(-1, PARTS, PART_BITS)
    low[:, :, PART_BITS : PART_BITS + 6] = np.unpackbits(np.arange(PARTS, dtype=np.uint8)[:, None], axis=1, bitorder="little")[None, :, :6]
    low[:, :, PART_BITS + 6 :] = bits[:, None, whole : whole + here]
    return _longs(low)[..., 0], _longs(bits[:, whole + here : whole + here + 64])[:, 0]


def _similar_links(sets: list[np.ndarray], ids: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """``_spanning`` for sets by their Jaccard similarity, found through the sets that hold each shingle."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    holders = owner[np.argsort(token, kind="stable")]
    ends = np.cumsum(np.bincount(token))
    begins = np.concatenate([[0], ends[:-1]])
    first = np.cumsum(size) - size

    def near(x: int, left: np.ndarray) -> np.ndarray:
        own = token[first[x] : first[x] + size[x]]
        n = ends[own] - begins[own]
        both = np.bincount(holders[np.arange(n.sum()) + np.repeat(begins[own] - (np.cumsum(n) - n), n)], minlength=len(sets))[left]
        return both >= similarity * (size[x] + size[left] - both) - 1e-9

    return _spanning(near, ids)


def similar(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 5, similarity: float = 0.8, bucket_rows: int = 20_000, crowd: int = CROWD) -> DataFrame:
    """(id, text_key, component_id, head_key): each row, ``xxhash64`` of its text, and the first of the rows it is linked with.

    Rows are linked if their sets of ``shingle`` words have a Jaccard similarity of ``similarity`` or more.  Equal sets
    are one node.  Wide fingerprints join nodes into groups that can hold links; each group's sets then meet, and
    only pairs that are similar enough stay linked.  The sets of a group of more than ``crowd`` shingles meet in blocks
    that different tasks take, two at a time, so the work for it grows with its square.  Of linked rows the
    first is the one of smallest id, then of smallest key.  Texts of fewer words than ``shingle`` have one
    shingle; texts without words are equal; rows without an id take no part and have a null component.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))

    def sets_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        data, offsets = flat(column)
        for i, j in slices(offsets):
            yield i, *_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shingle)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, size, wide = [], [], []
            for _, hashes, at in sets_of(batch.column(2)):
                raw = hashes.tobytes()
                digest += [xxhash.xxh3_128_digest(raw[8 * i : 8 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                wide += _longs(_wide(hashes, at)).tolist()
                size += np.diff(at).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(wide, pa.list_(pa.int64()))], ["id", "key", "digest", "size", "wide"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                low, far = _parts(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1))
                node = np.repeat(batch.column(1).to_numpy(), PARTS)
                yield pa.RecordBatch.from_arrays([pa.array(low.ravel()), pa.array(np.repeat(far, PARTS)), pa.array(node)], ["fp", "far", "rep"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, hashes, at in sets_of(batch.column(0)):
                own = [hashes[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                rest = batch.slice(i, len(own)).columns[1:]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(own, pa.binary())], ["node", "part", "block", "blocks", "own"])

    def meet(table: pa.Table) -> pa.Table:
        ids = table.column("node").to_numpy()
        edges = _similar_links([np.frombuffer(s.as_py(), np.uint64) for s in table.column("own")], ids, similarity)
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    signed = staged(rows.mapInArrow(sign, "id long, key long, digest binary, size long, wide array<long>"), "signs")
    nodes = signed.where("id is not null").groupBy("digest").agg(F.min(F.struct("id", "key")).alias("head"), F.first("size").alias("size"), F.first("wide").alias("wide"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # a set of n shingles has a similarity of n / (n + 1) at most with others
    wide = nodes.where(F.col("size") / (F.col("size") + 1) >= similarity - 1e-9).select("wide", "node")
    always = sum(1 << i for i in range(PART_BITS, PART_BITS + 6))
    near = links(wide.mapInArrow(deal, "fp long, far long, rep long"), 3, bucket_rows, 11, PART_BITS, always, NEAR_RADIUS)
    near = near.join(wide.selectExpr("node a", "wide wide_a"), "a").join(wide.selectExpr("node b", "wide wide_b"), "b")
    apart = F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    near = staged(near.where(apart <= WIDE_RADIUS).select("a", "b"), "pairs")
    # an eighth of the links joins most of a large group; of the rest only those between different parts go on
    some = staged(components(near.where("pmod(xxhash64(a, b), 8) = 0")), "groups")
    rest = near.join(some.selectExpr("node a", "component x"), "a", "left").join(some.selectExpr("node b", "component y"), "b", "left")
    rest = rest.selectExpr("coalesce(x, a) a", "coalesce(y, b) b").where("a <> b").distinct()
    groups = staged(components(rest.unionByName(some.selectExpr("node a", "component b"))), "groups")
    members = groups.join(nodes.select("node", "head", "size"), "node")
    blocks = members.groupBy("component").agg(F.expr(f"cast((sum(size) + {crowd - 1}) div {crowd} as int)").alias("blocks"))
    members = members.join(blocks, "component").select(
        F.col("head.id").alias("id"), F.col("head.key").alias("key"), "node", F.col("component").alias("part"), F.expr("cast(pmod(xxhash64(node), blocks) as int)").alias("block"), "blocks"
    )
    texts = rows.join(members, ["id", "key"]).select("text", "node", "part", "block", "blocks")
    if not signed.groupBy("id", "key").count().where("id is not null and count > 1").isEmpty():
        texts = texts.dropDuplicates(["node"])  # repeated rows have one set
    sets = texts.mapInArrow(send, "node long, part long, block int, blocks int, own binary")
    sets = sets.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    edges = staged(sets.select("part", "p", "q", "node", "own").groupBy("part", "p", "q").applyInArrow(meet, "a long, b long"), "near")
    found = components(edges)
    named = nodes.select("digest", "head", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = named.groupBy("component").agg(F.min("head").alias("first"))
    named = named.join(heads, "component").select("digest", "first")
    out = signed.join(named, "digest", "left")
    some = F.col("id").isNotNull()
    return out.select(
        F.col("id").alias(id_col), F.col("key").alias("text_key"), F.when(some, F.col("first.id")).alias("component_id"), F.when(some, F.col("first.key")).alias("head_key")
    )
