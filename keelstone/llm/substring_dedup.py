"""Substring deduplication: remove every passage of words that occurs more than once.

``passages`` deals the passages that can repeat to shards by content, so that a document is streamed
only to the shards that can know its passages.  A shard indexes its passages with an FM-index, whose
Burrows-Wheeler text lies in a wavelet matrix of packed bit vectors, and streams them against it:
backward search yields how far back the text that ends at a position occurs at two places or more (its matching
statistic).  Where this reaches ``length`` words, windows are removed; where it doesn't, no window around
what was read repeats, which decides most positions without a search of their own.

A passage that lies in the contexts of two anchors is in the index twice; an interval of suffixes
therefore counts only if it holds two different places.

Defined results: a null text has no words; a text shorter than ``length`` words keeps them; repeats
within one document count; repeated rows (equal ids and texts) are one document, whose passages repeat only
if other documents or other positions have them, and different texts with one id are different documents; rows
without an id are kept whole; an empty table gives an empty result.  Kept words are joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelstone.llm.common import flat, slices, words
from keelstone.llm.passages import Entries, Units, covered, documents, mask


class BitVector:
    """Packed bits with the number of ones before any position: 1.5 bits for each."""

    def __init__(self, bit: np.ndarray):
        packed = np.packbits(bit, bitorder="little")
        self.lanes = np.zeros(len(bit) // 64 + 1, np.uint64)
        self.lanes.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.lanes), np.int32)
        np.cumsum(np.bitwise_count(self.lanes[:-1]), out=self.before[1:])
        self.zeros = len(bit) - int(np.count_nonzero(bit))

    def ones(self, i: np.ndarray) -> np.ndarray:
        lane = i >> 6
        return self.before[lane] + np.bitwise_count(self.lanes[lane] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))


class WaveletMatrix:
    """Rank of any symbol in any prefix of a sequence, from one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in reversed(range(bits)):
            bit = (symbols >> level & 1).astype(bool)
            self.levels.append((level, BitVector(bit)))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self.base = self.descend(np.arange(1 << bits), np.zeros(1 << bits, np.int64)) if bits < 22 else None

    def descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, vector in self.levels:
            ones = vector.ones(i)
            i = np.where(symbol >> level & 1, vector.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = self.base[symbol] if self.base is not None else self.descend(symbol, np.zeros_like(i))
        return self.descend(symbol, i) - start


class FMIndex:
    """Backward search over a text of symbols, for patterns of up to ``depth`` of them.

    What stays is compressed: the wavelet matrix, the symbols' counts, and one bit for each suffix that tells
    whether its ``place`` differs from that of the suffix before it (or is of those that stand for ``several``).
    The suffix array itself goes, as the streamed documents know their own positions.
    """

    def __init__(self, text: np.ndarray, depth: int, place: np.ndarray, several: np.ndarray):
        n, rank, span = len(text), text.astype(np.int64), 1
        while span < depth:
            after = np.zeros(n, np.int64)
            after[: max(0, n - span)] = rank[span:] + 1
            _, rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
            span *= 2
        suffixes = np.argsort(rank, kind="stable")
        bits = max(1, int(text.max()).bit_length())
        self.matrix = WaveletMatrix(text[suffixes - 1], bits)
        place, several = place[suffixes], several[suffixes]
        self.changes = BitVector(np.concatenate([[False], place[1:] != place[:-1]]))
        self.many = BitVector(several)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])

    def start(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[symbol], self.first[symbol + 1]

    def repeated(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which intervals hold two different places, or one that stands for several."""
        out = high > low
        a, b = low[out], high[out]
        out[out] = (self.changes.ones(b) > self.changes.ones(a + 1)) | (self.many.ones(b) > self.many.ones(a))
        return out

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the pattern with ``symbol`` before it."""
        n = len(symbol)
        both = np.tile(self.first[symbol], 2) + self.matrix.rank(np.tile(symbol, 2), np.concatenate([low, high]))
        return both[:n], both[n:]


def _matching(index: FMIndex, text: np.ndarray, ends: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many symbols before each of ``ends``, ``most`` at most, occur together at two places or more."""
    reached = np.zeros(len(ends), np.int64)
    live = np.arange(len(ends))
    low, high = index.start(text[ends - 1])
    while True:
        several = index.repeated(low, high)
        live, low, high = live[several], low[several], high[several]
        reached[live] += 1
        going = reached[live] < most[live]
        live, low, high = live[going], low[going], high[going]
        if not len(live):
            return reached
        low, high = index.extend(text[ends[live] - 1 - reached[live]], low, high)


def resolver(length: int):
    def resolve(e: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        start, end, _ = words(e.data, np.append(e.a, e.b[-1:]))
        size = end - start
        raw = e.data[np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)]
        own = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(raw)])
        symbol = own.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
        # contexts one after the other, symbol 0 before each
        begin = np.cumsum(e.n + 1) - e.n
        text = np.zeros(int((e.n + 1).sum()), np.int64)
        place = np.arange(len(symbol)) + np.repeat(np.arange(len(e)), e.n) + 1
        text[place] = symbol
        # numbers of the places (document and word) at which suffixes stand
        doc = np.unique(np.stack([e.d.view(np.uint64), e.t]), axis=1, return_inverse=True)[1].ravel()
        at = np.zeros(len(text), np.int64)
        at[place] = np.repeat(e.at - begin, e.n) + place + 1
        index = FMIndex(text, 2 * length, np.repeat(doc, e.n + 1) * (int(at.max()) + 1) + at, np.repeat(e.many, e.n + 1))
        out = []
        # ends of windows still undecided, as ranges (entry, low, high); the first try is the last end
        entry = np.arange(len(e))
        low, high, end = np.full(len(entry), length), e.n[entry], e.n[entry]
        while len(entry):
            reached = _matching(index, text, begin[entry] + end, end)
            hit = reached >= length
            # a match reaching further back decides the windows within it
            first = np.maximum(low, end - reached + length)
            out.append((entry[hit], e.at[entry[hit]] + first[hit] - length, e.at[entry[hit]] + end[hit]))
            # what a failed one has read is unique, and so is every window around it
            below = np.where(hit, first, end) - 1
            above = np.where(hit, end, end - reached - 1 + length) + 1
            left, right = low <= below, above <= high
            entry = np.concatenate([entry[left], entry[right]])
            low, high = np.concatenate([low[left], above[right]]), np.concatenate([below[left], high[right]])
            end = (low + high + 1) // 2
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    return resolve


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = 35, sample: int = 8, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row's kept words as ``kept`` and (n_words, n_removed, kept_sha256); ``carry``: columns to keep."""
    units = Units("words", length, sample)
    rows = documents(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), *[F.col(c).alias(f"_{c}") for c in carry]))
    spans = covered(rows, units, True, resolver(length))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            kept, counts, removed = [], [], []
            for i, j in slices(offsets):
                start, end, first = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                gone = mask(batch.column("spans")[i:j], first)
                left = np.concatenate([[0], np.cumsum(~gone)])[first]
                counts += np.diff(first).tolist()
                removed += (np.diff(first) - np.diff(left)).tolist()
                start, end = start[~gone], end[~gone]
                size = end - start + 1
                to = np.concatenate([[0], np.cumsum(size)])
                joined = np.full(to[-1], 0x20, np.uint8)
                own = np.arange((size - 1).sum()) - np.repeat(np.cumsum(size - 1) - (size - 1), size - 1)
                joined[own + np.repeat(to[:-1], size - 1)] = data[offsets[i] + own + np.repeat(start, size - 1)]
                raw, at = joined.tobytes(), to[left].tolist()
                kept += [raw[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), *[batch.column(f"_{c}") for c in carry],
                ],
                names=out.names,
            )

    out = T.StructType.fromDDL("id long, kept string, n_words long, n_removed long, kept_sha256 string")
    for c in carry:
        out.add(f"_{c}", docs.schema[c].dataType)
    done = rows.join(spans, ["id", "tag"], "left").mapInArrow(cut, out)
    return done.select(F.col("id").alias(id_col), *out.names[1:5], *[F.col(f"_{c}").alias(c) for c in carry])
