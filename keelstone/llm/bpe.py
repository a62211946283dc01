"""Byte-level BPE by recursive DuckDB queries inside each partition.

A text is cut by the tokenizer's pattern.  A task keeps a bounded memo of the pieces it has met; new ones
become rows in a DuckDB database of the worker.  A recursive query joins those rows with the merge table
and contracts, in every step, each piece's pair of least rank (the leftmost, among equals), until no
pair can merge.  A row is a pair of neighbouring tokens with the places of both, so that a step needs no
sorting: the contracted pair goes, and its two neighbours take the new token.  Texts are put together from their
pieces' ids.  A second query joins the ids of whole texts with the vocabulary and decodes them by ordered aggregation.

Defined results: a null or empty text has no ids; repeated rows are encoded alike; an empty table gives
an empty result.  Special tokens are ordinary text.  A piece may be of any length (up to Arrow's 2 GB); one without any
break takes about a step for each different merge in it, a run of one character a step for each doubling.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import flat, slices

#: Pieces that a task remembers before it starts anew.
MEMO = 400_000

#: Bytes of new pieces that one recursive query contracts (one longer piece is taken alone), since it holds all its steps.
TOGETHER = 1 << 17

_STEPS = """
with recursive steps(step, w, lp, rp, l, r, k) as (
    select 0, w, lp, rp, l, r, ranked(n, lp, rp) from pairs left join merges using (l, r)
    union all
    select step, w, lp, rp, l, r, ranked(n, lp, rp) from (
        with least as (select w, min(k) k from steps group by w having min(k) is not null),
            chosen as (select w, (k >> 44)::int n, ((k >> 22) & 4194303)::int lp, (k & 4194303)::int rp from least)
        select s.step + 1 step, s.w, case when s.lp = c.rp then c.lp else s.lp end lp, s.rp,
            case when s.lp = c.rp then c.n else s.l end l, case when s.rp = c.lp then c.n else s.r end r
        from steps s join chosen c on s.w = c.w where s.lp <> c.lp)
    left join merges using (l, r)),
last as (select w, max(step) step from steps group by w)
select w, rp p, r t from steps join last using (w, step)"""

#: Bytes up to which a piece takes the steps above, where a place needs 22 bits at most; longer ones contract all pairs
#: of the least rank at once, which gives the same tokens in fewer steps.
SHORT = 64
#: Bytes of texts whose ids are decoded by one query.
DECODED = 1 << 21
#: Rows that the steps of long pieces may make before their last state is taken as a new start.
MOST_ROWS = 4_000_000

# Pairs of one rank that follow one another are a chain; every second one of it contracts, from the left.  All that
# is what single steps from the left would do next, unless the new token can merge at a lower rank than its own.
_LONG_STEPS = """
with recursive steps(step, w, lp, rp, l, r, k) as (
    select 0, w, lp, rp, l, r, n from pairs left join merges using (l, r)
    union all
    select step, w, lp, rp, l, r, n from (
        with least as (select w, min(k) n from steps where step < {limit} group by w having min(k) is not null),
            equal as (select s.w, lp, rp, n, lag(rp) over (partition by s.w order by lp) before from steps s join least b on s.w = b.w and s.k = n),
            chains as (select *, sum((before is null or before <> lp)::int) over (partition by w order by lp) chain from equal),
            chosen as (select w, lp, rp, n from (select *, row_number() over (partition by w, chain order by lp) i, row_number() over (partition by w order by lp) j from chains)
                where i % 2 = 1 and (j = 1 or n not in (select n from inverting)))
        select s.step + 1 step, s.w, coalesce(a.lp, s.lp) lp, s.rp, coalesce(a.n, s.l) l, coalesce(b.n, s.r) r
        from steps s join least on s.w = least.w left join chosen a on s.w = a.w and s.lp = a.rp left join chosen b on s.w = b.w and s.rp = b.lp
        where not exists (select 1 from chosen c where c.w = s.w and c.lp = s.lp))
    left join merges using (l, r)),
last as (select w, max(step) step from steps group by w)
select w, lp, rp, l, r, k from steps join last using (w, step)"""


class Vocabulary:
    """Ranks, merge table and database of one worker."""

    def __init__(self, ranks: bytes):
        tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        merges = [(tokens[t[:i]], tokens[t[i:]], n) for t, n in tokens.items() for i in range(1, len(t)) if t[:i] in tokens and t[i:] in tokens]
        self.byte = np.array([tokens[bytes([i])] for i in range(256)], np.int32)
        # nothing is written to a local folder: what a call makes is bounded, so it needs no spilling
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        columns = [pa.array(x, pa.int32()) for x in zip(*merges, strict=True)]
        self._table("merges", pa.table(columns, ["l", "r", "n"]))
        inverting = sorted({x for l, r, n in merges for x in (l, r) if x > n})
        self._table("inverting", pa.table({"n": pa.array(inverting, pa.int32())}))
        self._table("vocabulary", pa.table({"t": pa.array(tokens.values(), pa.int32()), "b": pa.array(list(tokens), pa.binary())}))
        self.db.execute("create macro ranked(n, lp, rp) as (n::bigint << 44) | (lp::bigint << 22) | rp")

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("incoming", rows)
        self.db.execute(f"create or replace table {name} as select * from incoming")
        self.db.unregister("incoming")

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each piece)."""
        data, offsets = flat(pieces)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        size = np.diff(offsets)
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        place = (np.arange(len(w)) - np.repeat(offsets[:-1], size) + 1).astype(np.int32)
        token = self.byte[data[: offsets[-1]]]
        # the first pair of a piece has no left token, and so never merges
        left = np.where(place == 1, -1, np.roll(token, 1)).astype(np.int32)
        rows = {"w": w, "lp": place - 1, "rp": place, "l": left, "r": token}
        long = np.repeat(size > SHORT, size)
        self._table("pairs", pa.table({k: v[~long] for k, v in rows.items()}))
        self.db.execute(f"create or replace table tokens as {_STEPS}")
        self._table("pairs", pa.table({k: v[long] for k, v in rows.items()}))
        while n := self.db.sql("select count(*) from pairs").fetchall()[0][0]:
            self.db.execute(f"create or replace table state as {_LONG_STEPS.format(limit=max(1, MOST_ROWS // n))}")
            self.db.execute("create or replace table open as select distinct w from state where k is not null")
            self.db.execute("insert into tokens select w, rp, r from state where w not in (select w from open)")
            self.db.execute("create or replace table pairs as select w, lp, rp, l, r from state where w in (select w from open)")
        ids = self.db.sql("select w, t from tokens order by w, p").to_arrow_table()
        counts = np.bincount(ids.column("w").to_numpy(), minlength=len(pieces))
        for name in ("pairs", "tokens", "state", "open"):  # a worker that waits for its next task holds the merge table only
            self.db.execute(f"drop table if exists {name}")
        return ids.column("t").to_numpy().astype(np.uint32), counts

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The bytes of each text's ids."""
        size = np.array([len(x) for x in texts])
        rows = {"w": np.repeat(np.arange(len(texts), dtype=np.int32), size), "p": np.arange(size.sum(), dtype=np.int32), "t": np.concatenate(texts).astype(np.int32)}
        self.db.register("incoming", pa.table(rows))
        found = self.db.sql("select w, list(b order by p) own from incoming join vocabulary using (t) group by w order by w").to_arrow_table().combine_chunks()
        self.db.unregister("incoming")
        out = [b""] * len(texts)
        for chunk in found.to_batches():
            data, ends = flat(chunk.column("own").flatten())
            ends = ends[np.concatenate([[0], np.cumsum(chunk.column("own").value_lengths().to_numpy())])]
            raw = data[ends[0] : ends[-1]].tobytes()
            for w, a, b in zip(chunk.column("w").to_pylist(), (ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist(), strict=True):
                out[w] = raw[a:b]
        return out


@lru_cache(2)
def _vocabulary(ranks: bytes) -> Vocabulary:
    return Vocabulary(ranks)


class _Store:
    """Values of many pieces, one after the other, that can be put together in any order."""

    def __init__(self, dtype: type):
        self.data, self.size = np.zeros(0, dtype), np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)

    def add(self, data: np.ndarray, size: np.ndarray) -> None:
        self.start = np.concatenate([self.start, len(self.data) + np.cumsum(size) - size])
        self.data, self.size = np.concatenate([self.data, data]), np.concatenate([self.size, size])

    def gather(self, which: np.ndarray) -> np.ndarray:
        size = self.size[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.data[np.arange(ends[-1]) + np.repeat(self.start[which] - ends[:-1], size)]


class _Memo(dict):
    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


def encode(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(carried columns, ids, decoded) of every row.

    ``ids``: binary, little-endian unsigned 32-bit integers; ``decoded``: the bytes they stand for.
    """
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    pattern = pattern or public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value)
        cut = regex.compile(pattern).findall
        memo, ids = _Memo(), _Store(np.uint32)
        for batch in batches:
            column = batch.column(0).fill_null("")
            for i, j in slices(flat(column)[1], 8 << 20):
                if len(memo) > MEMO:
                    memo, ids = _Memo(), _Store(np.uint32)
                which, counts = [], []
                for x in column[i:j]:
                    pieces = cut(x.as_py())
                    counts.append(len(pieces))
                    which.append(np.fromiter(map(memo.__getitem__, pieces), np.int32, len(pieces)))
                new = pa.array(islice(memo, len(ids.size), None), pa.string())
                found = [vocabulary.encode(new[a:b]) for a, b in slices(flat(new)[1], TOGETHER)]
                if found:
                    ids.add(*(np.concatenate(x) for x in zip(*found, strict=True)))
                own = [ids.gather(x) for x in which]
                packed = [x.astype("<u4").tobytes() for x in own]
                decoded = [x for a, b in slices(np.cumsum([0, *map(len, own)]), DECODED // 4) for x in vocabulary.decode(own[a:b])]
                rest = batch.slice(i, j - i).columns[1:]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())], [*carry, "ids", "decoded"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(F.col(text).alias("text"), *carry).mapInArrow(run, f"{kinds}, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """``encoded`` with its binaries replaced by n_tokens, ids_sha256 and decoded_sha256."""
    rest = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(
        *rest, F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
