"""Suffix-array deduplication: remove passages that an earlier document also has.

Suffixes are sorted by merging, and comparing two of them takes the length of their common
extension, which a binary search over polynomial prefix hashes finds in logarithmic time.  Suffixes
that compare as equal are verified byte by byte.  ``passages`` brings together the suffixes that can
be equal, at first within 8 MB of text and then in all of it, and cuts them to the bytes that matter.

Defined results: a null or empty text, or one shorter than ``length``, keeps its bytes (none for
null); rows with one id, whether their texts are equal or not, all keep what none shares with a smaller id;
rows without an id are kept whole and remove nothing elsewhere; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelstone.llm.common import flat, slices
from keelstone.llm.passages import Entries, PrefixHash, Units, byte_hash, covered, documents, join_windows, mask, same_bytes


class Suffixes:
    """Suffixes of ``data`` that begin at ``start`` and are read for ``size`` bytes."""

    def __init__(self, data: np.ndarray, hashes: PrefixHash, start: np.ndarray, size: np.ndarray):
        self.data, self.hashes, self.start, self.size = data, hashes, start, size

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y, by binary search."""
        a, b = self.start[x], self.start[y]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes.of(a, middle) == self.hashes.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before y (``or_equal``: or compares as equal)."""
        n = self.common(x, y)
        p, q = self.size[x], self.size[y]
        ended = n == np.minimum(p, q)
        last = len(self.data) - 1
        c, d = self.data[np.minimum(self.start[x] + n, last)], self.data[np.minimum(self.start[y] + n, last)]
        return np.where(ended, (p < q) | (or_equal & (p == q)), c < d)

    def sort(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, whether each is equal to the one before it), within runs of equal ``groups``.

        A bottom-up mergesort of all groups at once: each suffix finds its rank in the run that
        its own is merged with, by binary search.
        """
        n = len(groups)
        new = np.ones(n, bool)
        new[1:] = groups[1:] != groups[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        begin, end = np.repeat(first, size), np.repeat(first + size, size)
        place, order, run = np.arange(n), np.arange(n), 1
        while len(size) and run < size.max():
            block = begin + (place - begin) // (2 * run) * (2 * run)
            middle, stop = np.minimum(block + run, end), np.minimum(block + 2 * run, end)
            active = np.flatnonzero(middle < stop)
            here, block, middle, stop = place[active], block[active], middle[active], stop[active]
            left = here < middle
            low, high = np.where(left, middle, block), np.where(left, stop, middle)
            base = low.copy()
            own = here - np.where(left, block, middle)
            while (todo := np.flatnonzero(low < high)).size:
                probe = (low[todo] + high[todo]) // 2
                less = self.before(order[probe], order[here[todo]], ~left[todo])
                low[todo], high[todo] = np.where(less, probe + 1, low[todo]), np.where(less, high[todo], probe)
            merged = order.copy()
            merged[block + own + low - base] = order[here]
            order, run = merged, 2 * run
        equal = np.zeros(n, bool)
        x, y = order[:-1], order[1:]
        like = np.flatnonzero(~new[1:] & (self.size[x] == self.size[y]))
        like = like[self.common(x[like], y[like]) == self.size[x[like]]]
        equal[like + 1] = same_bytes(self.data, self.start[x[like]], self.start[y[like]], self.size[x[like]])
        return order, equal


def _smallest(order: np.ndarray, equal: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each suffix, smallest document of each class)."""
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(~equal) - 1
    least = np.full(int(kind.max()) + 1 if len(kind) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, kind, d)
    return kind, least


def suffix_order(e: Entries) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of each anchor in suffix order, and which equal the one before them."""
    by = np.argsort(e.h, kind="stable")
    s = e.take(by)
    order, equal = Suffixes(s.data, byte_hash(s.data), s.a, s.n).sort(s.h)
    return by[order], equal


def resolver(length: int):
    def resolve(e: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = byte_hash(e.data)
        order, equal = Suffixes(e.data, hashes, e.a, e.n).sort(e.h)
        kind, least = _smallest(order, equal, e.d)
        # an equal context of a smaller document covers all windows of this one
        later = e.d > least[kind]
        out = [(np.flatnonzero(later), e.at[later], (e.at + e.n)[later])]
        # one suffix for each window of each different context, if the anchor has several
        heads = order[~equal]
        h = e.h[heads]
        several = np.zeros(len(h), bool)
        several[1:] |= h[1:] == h[:-1]
        several[:-1] |= h[1:] == h[:-1]
        heads = heads[several]
        n = e.n[heads] - length + 1
        who = np.repeat(heads, n)
        step = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        start = e.a[who] + step
        offset = e.left[who] - step
        code = hashes.of(start, length)
        by = np.lexsort((code, offset, e.h[who]))
        h, o, c = e.h[who][by], offset[by], code[by]
        like = (h[1:] == h[:-1]) & (o[1:] == o[:-1]) & (c[1:] == c[:-1])
        met = np.zeros(len(by), bool)
        met[1:] |= like
        met[:-1] |= like
        by = by[met]
        who, step, start, offset = who[by], step[by], start[by], offset[by]
        group = np.cumsum(np.concatenate([[0], ((e.h[who][1:] != e.h[who][:-1]) | (offset[1:] != offset[:-1])).astype(np.int64)]))[: len(who)]
        sub_order, sub_equal = Suffixes(e.data, hashes, start, np.full(len(start), length)).sort(group)
        sub_kind, sub_least = _smallest(sub_order, sub_equal, least[kind[who]])
        hit = least[kind[who]] > sub_least[sub_kind]
        # what covers the context of a class covers it in each entry of its smallest document
        hit_kind, hit_step = kind[who[hit]], step[hit]
        own = np.flatnonzero(~later)
        own = own[np.argsort(kind[own], kind="stable")]
        first = np.searchsorted(kind[own], hit_kind)
        count = np.searchsorted(kind[own], hit_kind, "right") - first
        entry = own[np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)]
        out.append(join_windows(entry, e.at[entry] + np.repeat(hit_step, count), length))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    return resolve


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = 50, sample: int = 24, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row's kept text and (n_bytes, n_removed, n_spans, kept_sha256); ``carry``: columns to keep.

    ``kept`` is binary, as removal works on bytes and can cut a character.
    """
    units = Units("bytes", length, sample)
    rows = documents(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), *[F.col(c).alias(f"_{c}") for c in carry]))
    spans = covered(rows, units, False, resolver(length), suffix_order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            kept, removed, runs = [], [], []
            for i, j in slices(offsets):
                own = offsets[i : j + 1] - offsets[i]
                gone = mask(batch.column("spans")[i:j], own)
                piece = data[offsets[i] : offsets[j]]
                rises = gone.copy()
                rises[1:] &= ~gone[:-1]
                begin = own[own < len(gone)]
                rises[begin] = gone[begin]
                count = np.concatenate([[0], np.cumsum(gone)])
                removed += np.diff(count[own]).tolist()
                runs += np.diff(np.concatenate([[0], np.cumsum(rises)])[own]).tolist()
                raw, at = piece[~gone].tobytes(), (own - count[own]).tolist()
                kept += [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(kept, pa.binary()), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), *[batch.column(f"_{c}") for c in carry],
                ],
                names=out.names,
            )

    out = T.StructType.fromDDL("id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    for c in carry:
        out.add(f"_{c}", docs.schema[c].dataType)
    done = rows.join(spans, ["id", "tag"], "left").mapInArrow(cut, out)
    return done.select(F.col("id").alias(id_col), *out.names[1:6], *[F.col(f"_{c}").alias(c) for c in carry])
