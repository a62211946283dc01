"""Candidates for passages that occur more than once, gathered without comparing documents in pairs.

A passage is a window of ``length`` consecutive units (bytes, or words).  Every window owns one
*anchor*: the unit at which the smallest hash of ``sample`` units within the window begins.  Equal
windows own equal anchors, and neighbouring windows mostly share one, so anchors are few and yet no
repeated window lacks one.

1. ``shared_anchors``: each piece of an Arrow batch packs its anchors' hashes into one binary row
   for each hash range.  Anchors that meet within the piece are settled there, and one of them stands
   for all, so that a very frequent passage costs a range one entry for each piece and not one for
   each document.  The ranges report the anchors that occur again, packed for parts of the documents
   (8 MB of text each), and each part makes one row for each document of what all ranges report.
2. ``entries``: documents take their shared anchors back by a join on the id and send each one's
   *context*, all the windows that can own it, to the anchor's range.  Equal contexts of a piece are
   again settled in place.
3. The operator decides in each range which windows repeat (``resolve``), in pieces of whole anchors.
   An anchor with many different contexts (next to a frequent passage, where texts differ) is not
   sent there: ``crowded`` names these first, and each window that owns one goes to the range of its
   own content, once for each piece, so that equal windows still meet and no range grows with an anchor.
4. The covered spans go back to the documents by a second join, which reads the first one's shuffle.

Rows whose id is null take no part.  Ids must be integers.  A document is an id with a *tag*: 0 where ids are
unique, else a 64-bit hash of the text, so that different texts with one id are different documents of equal rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import flat, pieces, slices, words

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

#: Hash ranges at least, and bytes of text for each range beyond that; a range is what a task holds at once.
LEAST_RANGES, RANGE_BYTES = 16, 8 << 20

#: Bytes of text whose anchors are settled together before they are sent.
TOGETHER = 8 << 20

#: Entries that a range resolves at once, if no single anchor has more.
PIECE = 8_000

#: One of so many documents is read to find crowded anchors, and every one of more than LONG bytes.
SAMPLED, LONG = 64, 1 << 16

#: Crowded anchors that are dealt by window at most, the most crowded first: 8 MB that every task knows.
MOST_CROWDED = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to ``n``."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 18)
        both = []
        for base in (_BASE, _BASE_INVERSE):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x))
        _powers = both[0], both[1]
    return _powers


class PrefixHash:
    """Polynomial hashes of any run of a sequence, from the hashes of its prefixes."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values))
        self.prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.prefix[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]

    def fixed(self, length: int) -> np.ndarray:
        """Of every run of ``length``."""
        n = max(0, len(self.prefix) - length)
        return (self.prefix[length:][:n] - self.prefix[:n]) * self.down[:n]


def byte_hash(data: np.ndarray) -> PrefixHash:
    return PrefixHash(_BYTE[data])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def anchors(values: np.ndarray, offsets: np.ndarray, length: int, sample: int) -> tuple[np.ndarray, ...]:
    """(position, 48-bit hash, document, first window, windows) of the anchors of a sequence of units and of the windows that own them."""
    n_windows = np.maximum(0, np.diff(offsets) - length + 1)
    total = int(n_windows.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    h = mixed(PrefixHash(values).fixed(sample))
    bits = np.uint64(max(24, len(values).bit_length()))
    least = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    width, span = length - sample + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    begins = np.cumsum(n_windows) - n_windows
    own = least[np.arange(total) + np.repeat(offsets[:-1] - begins, n_windows)] & ((np.uint64(1) << bits) - np.uint64(1))
    first = _firsts(own)
    own = own[first].astype(np.int64)
    doc = np.searchsorted(offsets, own, "right") - 1
    return own, h[own] >> np.uint64(16), doc, first + (offsets[:-1] - begins)[doc], np.diff(np.append(first, total))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, each in the narrowest type that holds it, their first bytes together, then their second, as these compress better."""
    head, body = [len(arrays)], []
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        wide = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
        head += [wide, len(a)]
        body.append(a.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(head, "<i8").tobytes() + b"".join(body))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8), 8 + 16 * n, []
    for wide, size in head.reshape(-1, 2).tolist():
        planes = np.frombuffer(raw, np.uint8, size * wide, at).reshape(wide, size)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{wide}")[:, 0] if wide > 1 else planes[0])
        at += wide * size
    return out


class Units:
    """How a text is read: ``bytes`` or ``words``."""

    def __init__(self, kind: str, length: int, sample: int):
        self.kind, self.length, self.sample = kind, length, sample

    def __reduce__(self):
        return Units, (self.kind, self.length, self.sample)

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash value of each unit, offsets in units, first byte, end byte of each unit)."""
        if self.kind == "bytes":
            at = np.arange(len(data), dtype=np.int64)
            return _BYTE[data], offsets, at, at + 1
        start, end, first = words(data, offsets)
        return mixed(byte_hash(data).of(start, end - start)), first, start, end


def _ranges(h: np.ndarray, buckets: int) -> np.ndarray:
    """Number of each hash's range.  An anchor is the least hash of a window, so hashes are mixed anew to spread evenly."""
    return ((mixed(h * _BASE) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _by_range(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(stable order by range, where each range begins and ends in it)."""
    order = np.argsort(bucket, kind="stable")
    edge = np.append(_firsts(bucket[order]), len(order)).tolist()
    return order, list(zip(edge[:-1], edge[1:], strict=True))


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins, for sorted keys."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def to_parts(ids: np.ndarray, tags: np.ndarray, values: np.ndarray, parts: int) -> pa.Table:
    """(part, data): rows of values for documents, packed by the part that each document falls to."""
    part = _ranges(ids.view(np.uint64) ^ mixed(tags + _BASE), parts)
    order = np.lexsort((tags, ids, part))
    first = _firsts(part[order])
    ends = np.append(first, len(order))[1:]
    columns = np.ascontiguousarray(values).view(np.uint8)
    data = []
    for i, j in zip(first.tolist(), ends.tolist(), strict=True):
        k = order[i:j]
        d = ids[k].view(np.uint64)
        data.append(pack(d[:1], d - np.append(d[:1], d[:-1]), tags[k], columns[k].T.ravel()))
    return pa.table({"part": pa.array(part[order[first]].astype(np.int64), pa.int64()), "data": pa.array(data, pa.binary())})


def by_document(table: pa.Table) -> pa.Table:
    """(id, tag, found): all values that ranges packed for the documents of a part, one row for each document."""
    rows = [unpack(x.as_py()) for x in table.column("data")]
    ids = np.concatenate([(np.cumsum(r[1], dtype=np.uint64) + r[0].astype(np.uint64)).view(np.int64) for r in rows])
    tags = np.concatenate([r[2].astype(np.uint64) for r in rows])
    values = np.concatenate([r[3].reshape(-1, len(r[1])).T for r in rows])
    order = np.lexsort((tags, ids))
    ids, tags, values = ids[order], tags[order], values[order]
    first = _firsts(ids, tags)
    ends = np.append(first, len(ids))[1:]
    found = [values[i:j].tobytes() for i, j in zip(first.tolist(), ends.tolist(), strict=True)]
    return pa.table({"id": pa.array(ids[first], pa.int64()), "tag": pa.array(tags[first].view(np.int64), pa.int64()), "found": pa.array(found, pa.binary())})


def _narrow(h: np.ndarray) -> np.ndarray:
    """48-bit hashes as six bytes each."""
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]


def _hashes(found: bytes) -> np.ndarray:
    own = np.frombuffer(found, np.uint8).reshape(-1, 6)
    out = np.zeros((len(own), 8), np.uint8)
    out[:, :6] = own
    return out.view("<u8")[:, 0]


def _spans(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([a, b], 1).astype(np.int32)


def _less(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, differences from it) of ids, to be packed."""
    low = d.min()
    return np.array([low], np.int64).view(np.uint64), d.astype(np.uint64) - low.astype(np.uint64)


def _more(low: np.ndarray, d: np.ndarray) -> np.ndarray:
    return (d.astype(np.uint64) + low.astype(np.uint64)[0]).view(np.int64)


def shared_anchors(docs: DataFrame, units: Units, buckets: int, within: bool) -> DataFrame:
    """(id, tag, found): hashes of the anchors that other documents have as well (``within``: or the same again)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2, TOGETHER):
            if batch.column(0).null_count:
                batch = batch.filter(batch.column(0).is_valid())
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            data, offsets = flat(batch.column(2))
            parts = []
            for i, j in slices(offsets):
                values, own, _, _ = units.read(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                _, h, doc, _, _ = anchors(values, own, units.length, units.sample)
                parts.append((h, ids[doc + i], tags[doc + i].view(np.uint64)))
            if not parts:
                continue
            h, d, t = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((t, d, h))
            h, d, t = h[order], d[order], t[order]
            first = _firsts(h, d, t)
            again = np.diff(np.append(first, len(h))) > 1
            h, d, t = h[first], d[first], t[first]
            first = _firsts(h)
            size = np.diff(np.append(first, len(h)))
            here = size > 1
            if within and len(h):
                here |= np.logical_or.reduceat(again, first)
            settled = np.repeat(here, size)
            out = []
            if settled.any():
                low, more = _less(d[settled])
                out.append((-1 - int(low[0]) % buckets, pack(low, h[settled], more, t[settled])))
            h, d, t = h[first], d[first], t[first]
            bucket = _ranges(h, buckets)
            order, edges = _by_range(bucket)
            h, d, t, here, bucket = h[order], d[order], t[order], here[order], bucket[order]
            for i, j in edges:
                steps = np.diff(h[i:j], prepend=np.uint64(0))
                out.append((int(bucket[i]), pack(*_less(d[i:j]), t[i:j], steps[:1], steps[1:], np.packbits(here[i:j]))))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["bucket", "data"])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        rows = [unpack(x.as_py()) for x in table.column("data")]
        if key[0].as_py() < 0:
            h, t = (np.concatenate([r[k].astype(np.uint64) for r in rows]) for k in (1, 3))
            return to_parts(np.concatenate([_more(r[0], r[2]) for r in rows]), t, _narrow(h), buckets)
        h = np.concatenate([np.cumsum(np.concatenate([r[3], r[4]]), dtype=np.uint64) for r in rows])
        d = np.concatenate([_more(r[0], r[1]) for r in rows])
        t = np.concatenate([r[2].astype(np.uint64) for r in rows])
        here = np.concatenate([np.unpackbits(r[5], count=len(r[1])) for r in rows]).astype(bool)
        order = np.argsort(h, kind="stable")
        h, d, t, here = h[order], d[order], t[order], here[order]
        first = _firsts(h)
        size = np.diff(np.append(first, len(h)))
        report = np.repeat(size > 1, size) & ~here
        return to_parts(d[report], t[report], _narrow(h[report]), buckets)

    sent = docs.select("id", "tag", "text").mapInArrow(send, "bucket long, data binary")
    return gathered(sent.groupBy("bucket").applyInArrow(meet, "part long, data binary"))


def gathered(packed: DataFrame) -> DataFrame:
    """(id, tag, found): one row for each document, from (part, data)."""
    return packed.groupBy("part").applyInArrow(by_document, "id long, tag long, found binary")


class Entries:
    """Shared anchors with their contexts; one array element each, context bytes in one buffer.

    h: anchor's hash; d, t: document's id and tag; at: first unit of the context in the document; left: units before
    the anchor; n: units of the context; a, b: its bytes in ``data``; many: stands for equal contexts
    of other places as well.
    """

    names = ("h", "d", "t", "at", "left", "n", "a", "b", "many")

    def __init__(self, data: np.ndarray, **arrays: np.ndarray):
        self.data = data
        for k in self.names:
            setattr(self, k, arrays[k])

    def __len__(self) -> int:
        return len(self.h)

    def take(self, which: np.ndarray) -> Entries:
        return Entries(self.data, **{k: getattr(self, k)[which] for k in self.names})

    def compact(self) -> Entries:
        """With a buffer of its own, contexts one after the other."""
        size = self.b - self.a
        ends = np.cumsum(size)
        out = self.take(np.arange(len(self)))
        out.data = self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.a - (ends - size), size)]
        out.a, out.b = ends - size, ends
        return out

    @staticmethod
    def join(parts: list[Entries]) -> Entries:
        shift = np.cumsum([0, *(len(p.data) for p in parts)])
        arrays = {k: np.concatenate([getattr(p, k) + (shift[i] if k in "ab" else 0) if k in "ab" else getattr(p, k) for i, p in enumerate(parts)]) for k in Entries.names}
        return Entries(np.concatenate([p.data for p in parts]), **arrays)

    def packed(self) -> bytes:
        return pack(*_less(self.d), self.t, self.h, self.at, self.left, self.n, self.b - self.a, np.packbits(self.many), self.data)

    @staticmethod
    def unpacked(raw: bytes) -> Entries:
        low, d, t, h, at, left, n, size, many, data = unpack(raw)
        b = np.cumsum(size, dtype=np.int64)
        return Entries(
            data, h=h.astype(np.uint64), d=_more(low, d), t=t.astype(np.uint64), at=at.astype(np.int64), left=left.astype(np.int64),
            n=n.astype(np.int64), a=b - size, b=b, many=np.unpackbits(many, count=len(h)).astype(bool),
        )


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the runs of ``size`` bytes at ``a`` and at ``b`` are equal."""
    if not len(a):
        return np.zeros(0, bool)
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    same = data[np.repeat(a, size) + step] == data[np.repeat(b, size) + step]
    return np.logical_and.reduceat(same, np.minimum(first, len(same) - 1)) | (size == 0)


#: Puts the contexts of each anchor in order: (order, whether each equals the one before it).
Sort = Callable[[Entries], tuple[np.ndarray, np.ndarray]]


def sort_by_hash(e: Entries) -> tuple[np.ndarray, np.ndarray]:
    """Equal contexts next to each other, by their hashes and then their bytes."""
    code = byte_hash(e.data).of(e.a, e.b - e.a)
    order = np.lexsort((e.n, code, e.h))
    s, code = e.take(order), code[order]
    equal = np.zeros(len(s), bool)
    if len(s):
        equal[1:] = (s.h[1:] == s.h[:-1]) & (code[1:] == code[:-1]) & (s.n[1:] == s.n[:-1]) & ((s.b - s.a)[1:] == (s.b - s.a)[:-1])
        at = np.flatnonzero(equal)
        equal[at] = same_bytes(s.data, s.a[at - 1], s.a[at], (s.b - s.a)[at])
    return order, equal


def settle(e: Entries, within: bool, sort: Sort) -> tuple[Entries, np.ndarray]:
    """What still has to go to the range, and which entries are covered as a whole already.

    Equal contexts settle each other: all but the smallest document's are covered, or all of them
    if repeats count ``within`` a document; then one stands for them.
    """
    order, equal = sort(e)
    # the anchor's place is part of what makes two contexts alike
    kind = np.empty(len(e), np.int64)
    kind[order] = np.cumsum(~equal)
    order = np.lexsort((e.at, e.t, e.d, e.left, kind))
    s = e.take(order)
    first = _firsts(kind[order], s.left)
    size = np.diff(np.append(first, len(s)))
    if within:
        # equal rows are one document: the same place does not repeat
        moved = np.zeros(len(s), bool)
        moved[1:] = (s.d[1:] != s.d[:-1]) | (s.t[1:] != s.t[:-1]) | (s.at[1:] != s.at[:-1])
        moved[first] = False
        many = np.logical_or.reduceat(moved, first) if len(s) else moved
        covered = np.repeat(many, size)
        rest = s.take(first)
        rest.many = many
    else:
        covered = s.d > np.repeat(s.d[first], size)
        rest = s.take(np.flatnonzero(~covered))
    out = np.zeros(len(e), bool)
    out[order] = covered
    return rest, out


def crowded(docs: DataFrame, units: Units) -> np.ndarray:
    """Hashes of the anchors that have about ``PIECE`` different contexts or more, by a sample of documents.

    Any choice gives the same spans, as all documents follow it; it only bounds what meets in a range.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, TOGETHER):
            data, offsets = flat(batch.column(0))
            for i, j in slices(offsets):
                text = data[offsets[i] : offsets[j]]
                values, own, start, end = units.read(text, offsets[i : j + 1] - offsets[i])
                p, h, doc, _, _ = anchors(values, own, units.length, units.sample)
                if not len(p):
                    continue
                low = np.maximum(own[doc], p - (units.length - units.sample))
                high = np.minimum(own[doc + 1], p + units.length)
                code = mixed(byte_hash(text).of(start[low], end[high - 1] - start[low]) + (p - low).astype(np.uint64))
                weight = batch.column(1).to_numpy(zero_copy_only=False)[i:j][doc]
                order = np.lexsort((weight, code, h))
                order = order[_firsts(h[order], code[order])]
                columns = h[order].view(np.int64), code[order].view(np.int64), weight[order]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "code", "weight"])

    long = F.octet_length("text") > LONG
    some = docs.where(F.col("id").isNotNull() & (long | (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SAMPLED)) == 0)))
    found = some.select("text", F.when(long, 1).otherwise(SAMPLED).cast("long").alias("weight")).mapInArrow(send, "h long, code long, weight long")
    found = found.groupBy("h", "code").agg(F.min("weight").alias("weight")).groupBy("h").agg(F.sum("weight").alias("n"))
    most = found.where(F.col("n") >= PIECE).orderBy(F.col("n").desc(), "h").limit(MOST_CROWDED)
    return np.array(sorted(r["h"] for r in most.select("h").collect()), np.int64).view(np.uint64)


def settle_windows(digest: np.ndarray, d: np.ndarray, t: np.ndarray, at: np.ndarray, many: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows that still have to be sent, which of these stand for several places, which windows are covered), as in ``settle``."""
    order = np.lexsort((at, t, d, digest[:, 1], digest[:, 0]))
    s, d, t, at, many = digest[order], d[order], t[order], at[order], many[order]
    first = _firsts(s[:, 0], s[:, 1])
    size = np.diff(np.append(first, len(s)))
    out = np.zeros(len(s), bool)
    if not within:
        late = d > np.repeat(d[first], size)
        out[order] = late
        return order[~late], many[~late], out
    moved = many.copy()
    moved[1:] |= (s[1:] == s[:-1]).all(1) & ((d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (at[1:] != at[:-1]))
    several = np.logical_or.reduceat(moved, first) if len(s) else moved
    out[order] = np.repeat(several, size)
    return order[first], several, out


def entries(docs: DataFrame, flagged: DataFrame, units: Units, buckets: int, within: bool, crowd: np.ndarray, sort: Sort) -> DataFrame:
    """(bucket, data): contexts by hash range, and from ``buckets`` on windows of crowded anchors; below 0 the spans that the batch settled itself."""

    def windows(text: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> np.ndarray:
        """128-bit digests of the windows that begin at the units ``first``."""
        raw = text.tobytes()
        a, b = start[first].tolist(), end[first + units.length - 1].tolist()
        parts = (raw[i:j] for i, j in zip(a, b, strict=True))
        if units.kind == "words":
            parts = (b" ".join(x.split()) for x in parts)
        return np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in parts), "<u8").reshape(-1, 2)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2, TOGETHER):
            if batch.column(3).null_count:
                batch = batch.filter(batch.column(3).is_valid())
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            tags = tags.view(np.uint64)
            data, offsets = flat(batch.column(2))
            found = batch.column(3)
            kept, done, dealt = [], [], []
            for i, j in slices(offsets):
                text = data[offsets[i] : offsets[j]]
                values, own, start, end = units.read(text, offsets[i : j + 1] - offsets[i])
                p, h, doc, w, n = anchors(values, own, units.length, units.sample)
                hot = np.isin(h, crowd)
                if hot.any():
                    size = n[hot]
                    step = np.repeat(w[hot] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    of = np.repeat(doc[hot], size)
                    dealt.append((windows(text, start, end, step), ids[of + i], tags[of + i], step - own[of]))
                wanted = [_hashes(x.as_py()) for x in found[i:j]]
                salt = np.repeat(np.arange(j - i, dtype=np.uint64), [len(x) for x in wanted]) * _BASE
                hit = np.isin(h ^ (doc.astype(np.uint64) * _BASE), np.concatenate(wanted) ^ salt) if len(h) else np.zeros(0, bool)
                hit &= ~hot
                p, h, doc = p[hit], h[hit], doc[hit]
                if not len(p):
                    continue
                low = np.maximum(own[doc], p - (units.length - units.sample))
                high = np.minimum(own[doc + 1], p + units.length)
                e = Entries(text, h=h, d=ids[doc + i], t=tags[doc + i], at=low - own[doc], left=p - low, n=high - low, a=start[low], b=end[high - 1], many=np.zeros(len(p), bool))
                rest, covered = settle(e, within, sort)
                done.append((e.d[covered], e.t[covered], e.at[covered], e.n[covered]))
                kept.append(rest.compact())
            out = []
            if dealt:
                digest, d, t, at = (np.concatenate(x) for x in zip(*dealt, strict=True))
                rest, many, gone = settle_windows(digest, d, t, at, np.zeros(len(d), bool), within)
                done.append((d[gone], t[gone], at[gone], np.full(int(gone.sum()), units.length)))
                digest, d, t, at = digest[rest], d[rest], t[rest], at[rest]
                bucket = _ranges(digest[:, 0], buckets)
                order, edges = _by_range(bucket)
                for i, j in edges:
                    k = order[i:j]
                    out.append((buckets + int(bucket[k[0]]), pack(*_less(d[k]), t[k], digest[k, 0], digest[k, 1], at[k], many[k])))
            if done:
                d, t, at, n = (np.concatenate(x) for x in zip(*done, strict=True))
                if len(d):
                    low, more = _less(d)
                    out.append((-1 - int(low[0]) % buckets, pack(low, more, t, at, n)))
            if kept:
                e = Entries.join(kept)
                e = e.take(np.argsort(e.h, kind="stable"))
                bucket = _ranges(e.h, buckets)
                order, edges = _by_range(bucket)
                for i, j in edges:
                    out.append((int(bucket[order[i]]), e.take(order[i:j]).compact().packed()))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["bucket", "data"])

    return docs.join(flagged, ["id", "tag"], "left").select("id", "tag", "text", "found").mapInArrow(send, "bucket long, data binary")


def join_windows(entry: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, first, end) of the spans of windows that begin at ``at``."""
    by = np.lexsort((at, entry))
    entry, at = entry[by], at[by]
    first = np.flatnonzero(np.concatenate([[True], (entry[1:] != entry[:-1]) | (at[1:] > at[:-1] + 1)])[: len(at)])
    last = np.append(first, len(at))[1:] - 1
    return entry[first], at[first], at[last] + length


#: From the contexts of some anchors, (entry, first unit, end unit) of the spans that repeated windows cover.
Resolve = Callable[[Entries], tuple[np.ndarray, np.ndarray, np.ndarray]]


def documents(docs: DataFrame) -> DataFrame:
    """(id, text, ...) with the documents' tags."""
    again = docs.where("id is not null").groupBy("id").count().where("count > 1")
    # rows without an id take no part, and are spread by their text
    alone = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return docs.withColumn("tag", alone if again.isEmpty() else F.xxhash64("text"))


def covered(docs: DataFrame, units: Units, within: bool, resolve: Resolve, sort: Sort = sort_by_hash) -> DataFrame:
    """(id, tag, spans): for each of ``documents`` with any, the spans of units that repeated windows cover, as pairs of 32-bit integers."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_RANGES, -(-size // RANGE_BYTES))

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            rows = [unpack(x.as_py()) for x in table.column("data")]
            d = np.concatenate([_more(r[0], r[1]) for r in rows])
            t, a, n = (np.concatenate([r[k].astype(np.uint64) for r in rows]) for k in (2, 3, 4))
            return to_parts(d, t, _spans(a, a + n), buckets)
        if key[0].as_py() >= buckets:
            rows = [unpack(x.as_py()) for x in table.column("data")]
            d = np.concatenate([_more(r[0], r[1]) for r in rows])
            t, x, y, at = (np.concatenate([r[k].astype(np.uint64) for r in rows]) for k in (2, 3, 4, 5))
            at = at.astype(np.int64)
            gone = settle_windows(np.stack([x, y], 1), d, t, at, np.concatenate([r[6].astype(bool) for r in rows]), within)[2]
            return to_parts(d[gone], t[gone], _spans(at[gone], at[gone] + units.length), buckets)
        e = Entries.join([Entries.unpacked(x.as_py()) for x in table.column("data")])
        e = e.take(np.argsort(e.h, kind="stable"))
        first = _firsts(e.h)
        size = np.diff(np.append(first, len(e)))
        e = e.take(np.flatnonzero(np.repeat(size > 1, size)))  # `settle` covered what a lone entry stands for
        first = _firsts(e.h)
        ends, at, found = np.append(first, len(e))[1:], 0, [(np.zeros(0, np.int64),) * 3]
        while at < len(e):
            i = int(np.searchsorted(ends, at + PIECE, "right"))
            to = int(ends[i - 1]) if i and ends[i - 1] > at else int(ends[i])
            entry, a, b = resolve(e.take(slice(at, to)).compact())
            found.append((entry + at, a, b))
            at = to
        entry, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return to_parts(e.d[entry], e.t[entry], _spans(a, b), buckets)

    flagged = shared_anchors(docs, units, buckets, within)
    spans = entries(docs, flagged, units, buckets, within, crowded(docs, units), sort).groupBy("bucket").applyInArrow(meet, "part long, data binary")
    return gathered(spans).withColumnRenamed("found", "spans")


def mask(spans: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """Which of the units between ``offsets`` the documents' spans cover."""
    change = np.zeros(offsets[-1] + 1, np.int64)
    for i, x in enumerate(spans):
        if x.is_valid:
            pairs = np.minimum(np.frombuffer(x.as_py(), np.int32).reshape(-1, 2) + offsets[i], offsets[i + 1])
            np.add.at(change, pairs[:, 0], 1)
            np.subtract.at(change, pairs[:, 1], 1)
    return np.cumsum(change[:-1]) > 0
