"""Language identification in two steps: the language family, then the language within it.

A text is read as relative frequencies of hashed two- and three-byte runs of its letters (square
roots of them, so that a dot product compares distributions).  One linear support vector machine for
each family against the rest picks the family; within a family, one for each pair of languages votes.

The model is fitted on the driver from at most ``per_lang`` rows of each language, chosen by a hash
of the id and the text; that is the only sampling.  Every whole text is scored in Arrow batches.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text if
nothing can be learned; rows with a null id count as ids of the empty text; repeated rows are scored
alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import flat, hash_bound, slices

#: Families of languages by code; a language that isn't here is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

PAIRS, TRIPLES = 1024, 2048
WIDTH = PAIRS + TRIPLES

#: Letters in lower case, bytes of longer characters as they are, anything else as a space.
_FOLD = np.full(256, 0x20, np.uint64)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the relative frequencies of runs, one row for each text."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    t = _FOLD[data]
    out = np.zeros((n, WIDTH))
    for size, base, width in ((2, 0, PAIRS), (3, PAIRS, TRIPLES)):
        if len(t) < size:
            continue
        last = len(t) - size + 1
        code = t[:last].copy()
        for k in range(1, size):
            code = code << np.uint64(8) | t[k : last + k]
        blank = int.from_bytes(b" " * size, "big")
        good = (doc[:last] == doc[size - 1 :]) & (code != blank)
        cell = (code[good] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % width
        counts = np.bincount(doc[:last][good] * width + cell, minlength=n * width).reshape(n, width)
        out[:, base : base + width] = counts / np.maximum(1, counts.sum(1, keepdims=True)) / 2
    return np.sqrt(out)


def _svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, classes weighed alike (y is -1 or 1)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = v = np.zeros(x.shape[1])
    rate, t = 1 / (4 * float((share[:, None] * x * x).sum()) + penalty), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        step = v - rate * (penalty * v - 2 * x.T @ (share * y * slack))
        ahead = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = step + (t - 1) / ahead * (step - w), step, ahead
    return w


class Model:
    """Machines by row: first one for each family, then one for each pair of languages of a family."""

    def __init__(self, langs: np.ndarray, x: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        own = {lang: FAMILY.get(lang, lang) for lang in self.langs}
        self.families = sorted(set(own.values()))
        self.member = np.array([self.families.index(own[lang]) for lang in self.langs])
        family = np.array([own[lang] for lang in langs.tolist()])
        several = len(self.families) > 1
        rows = [_svm(x, np.where(family == f, 1.0, -1.0)) if several else np.zeros(WIDTH + 1) for f in self.families]
        self.pairs = [(i, j) for i, j in combinations(range(len(self.langs)), 2) if self.member[i] == self.member[j]]
        for i, j in self.pairs:
            some = np.isin(langs, (self.langs[i], self.langs[j]))
            rows.append(_svm(x[some], np.where(langs[some] == self.langs[i], 1.0, -1.0)))
        self.weights = np.array(rows)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language, how sure)."""
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        k = len(self.families)
        family = margin[:, :k].argmax(1)
        sure = 1 / (1 + np.exp(-4 * margin[np.arange(len(x)), family])) if k > 1 else np.ones(len(x))
        votes = np.where(self.member[None, :] == family[:, None], 0.0, -np.inf)
        chance = np.zeros_like(votes)
        rivals = np.zeros(len(self.langs))
        for (i, j), m in zip(self.pairs, margin[:, k:].T, strict=True):
            p = 1 / (1 + np.exp(-4 * m))
            votes[:, i] += (m > 0) + p / 8  # a tie in votes goes to the larger margins
            votes[:, j] += (m <= 0) + (1 - p) / 8
            chance[:, i] += p
            chance[:, j] += 1 - p
            rivals[[i, j]] += 1
        lang = votes.argmax(1)
        alone = rivals[lang] == 0
        return lang, sure * np.where(alone, 1.0, chance[np.arange(len(x)), lang] / np.maximum(1, rivals[lang]))


def held_out(id_col: str) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang", per_lang: int = 800) -> Model | None:
    """Learn from the rows that aren't held out and have a text and a language."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id_col))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(id_col, text).alias("rank"))
    # one row for each language, of which the model has machines for every pair
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    bounds = [F.lit(x) for name, n in counts.items() for x in (name, hash_bound(n, per_lang))]
    if not bounds:
        return None
    rows = rows.where(F.col("rank") <= F.create_map(*bounds)[F.col("lang")]).where(F.rlike("text", F.lit(r"\p{L}")))
    chosen = rows.withColumn("row", F.expr("row_number() over (partition by lang order by rank, text)")).where(f"row <= {per_lang}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            x = [features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in slices(offsets)]
            x = [r.astype(np.float32).tobytes() for part in x for r in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], ["lang", "x"])

    found = chosen.select("lang", "text").mapInArrow(run, "lang string, x binary").toArrow()
    if not len(found):
        return None
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(len(found), WIDTH).astype(float)
    return Model(np.array(found.column("lang").to_pylist(), object), x)


def identify(docs: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang", model: Model | None = None) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; ``model``: one to use instead of fitting."""
    model = model or fit(docs, text, id_col, lang)
    rows = docs.select(F.col(id_col).alias("id"), F.when(F.rlike(text, F.lit(r"\p{L}")), F.col(text)).alias("text"), held_out(id_col).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            named, scores = [], []
            for i, j in slices(offsets):
                if model is None:
                    named += ["und"] * (j - i)
                    scores += [0.0] * (j - i)
                    continue
                lang, sure = model.predict(features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                named += [model.langs[k] for k in lang]
                scores += sure.tolist()
            some = batch.column(1).is_valid().to_pylist()
            named = [x if s else "und" for x, s in zip(named, some, strict=True)]
            scores = [x if s else 0.0 for x, s in zip(scores, some, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(named, pa.string()), pa.array(scores, pa.float64())], ["id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    done = rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double")
    return done.withColumnRenamed("id", id_col)
