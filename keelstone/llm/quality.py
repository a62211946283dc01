"""Quality classification by a sparse ensemble of rules.

Small trees over statistics of a text are grown on bootstrap samples.  Every path in them becomes a rule,
a conjunction of thresholds; a logistic regression with a lasso penalty weighs the rules and drops most;
those that stay become one Spark column expression, so scoring is part of the query plan.

Statistics of every whole text are computed in Arrow batches.  The rules are fitted on the driver from at
most ``per_class`` labelled rows of each class, chosen by a hash of the id; that is the only sampling.

Defined results: a null text is scored as an empty one; without rows of both classes to learn from the
score is the share of class 1 (0.5 without any); rows with a null id count as ids of the empty text;
repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import flat, hash_bound, slices, words
from keelstone.llm.language import held_out
from keelstone.llm.passages import PrefixHash, byte_hash, mixed

STATISTICS = (
    "bytes", "words", "word_bytes", "longest_word", "letters", "upper", "digits", "symbols", "marks", "distinct", "commonest", "distinct_pairs",
    "lines", "line_words", "repeated_lines", "bare_words", "ended_words", "capital_words",
)

_LETTER, _UPPER, _DIGIT, _SYMBOL, _MARK = np.zeros((5, 256), bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = True
_MARK[list(b"!\"'(),-.:;?")] = True


def _distinct(doc: np.ndarray, code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of different codes, count of the commonest one) in each document."""
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])])[: len(doc)])
    size = np.diff(np.append(first, len(doc)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc[first], size)
    return np.bincount(doc[first], minlength=n), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text; shares are 0 where there is nothing to count."""
    n = len(offsets) - 1
    size = np.diff(offsets)

    def per_text(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flag)])[offsets])

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(1, b)

    letters = _LETTER[data]
    n_letters, upper = per_text(letters), per_text(_UPPER[data])
    start, end, first = words(data, offsets)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(n), n_words)
    hashes = byte_hash(data)
    code = hashes.of(start, end - start)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, doc, end - start)
    distinct, commonest = _distinct(doc, code, n)
    pair = doc[1:] == doc[:-1]
    pairs, _ = _distinct(doc[1:][pair], PrefixHash(mixed(code)).fixed(2)[pair] if len(code) > 1 else code[:0], n)
    breaks = data == 0x0A
    line_end = np.unique(np.concatenate([np.flatnonzero(breaks), offsets[1:] - 1]))
    line_end = line_end[line_end >= 0]
    line_start = np.concatenate([[0], line_end[:-1] + 1])[: len(line_end)]
    line_doc = np.searchsorted(offsets, line_end, "right") - 1
    length = line_end + ~breaks[line_end] - line_start
    some = length > 0
    line_doc, line_start, length = line_doc[some], line_start[some], length[some]
    n_lines = np.bincount(line_doc, minlength=n)
    own_lines, _ = _distinct(line_doc, hashes.of(line_start, length), n)
    seen = np.concatenate([[0], np.cumsum(letters)])
    bare = np.bincount(doc, seen[end] == seen[start], minlength=n)
    last = data[end - 1] if len(end) else data[:0]
    ended = np.bincount(doc, ~_LETTER[last], minlength=n)
    capital = np.bincount(doc, _UPPER[data[start]] if len(start) else None, minlength=n) if len(start) else np.zeros(n)
    columns = (
        size, n_words, share(per_text(~(data <= 0x20)), n_words), longest, share(n_letters, size), share(upper, n_letters), share(per_text(_DIGIT[data]), size),
        share(per_text(_SYMBOL[data]), size), share(per_text(_MARK[data]), size), share(distinct, n_words), share(commonest, n_words), share(pairs, n_words - 1),
        n_lines, share(n_words, n_lines), share(n_lines - own_lines, n_lines), share(bare, n_words), share(ended, n_words), share(capital, n_words),
    )
    return np.stack([np.asarray(c, float) for c in columns], 1)


def measured(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``text`` replaced by its STATISTICS."""
    keep = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(text))
            parts = [statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in slices(offsets)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *map(pa.array, x.T)], [*keep, *STATISTICS])

    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep] + [f"{s} double" for s in STATISTICS])
    return rows.mapInArrow(run, schema)


#: (statistic, above, threshold): above, or else at most, the threshold.
Condition = tuple[int, bool, float]


@dataclass
class Rules:
    intercept: float
    weights: list[tuple[frozenset[Condition], float]]

    def score(self) -> Column:
        """The probability of class 1 as an expression over STATISTICS."""
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            met = F.lit(True)
            for k, above, limit in sorted(rule):
                met = met & ((F.col(STATISTICS[k]) > limit) if above else (F.col(STATISTICS[k]) <= limit))
            total = total + F.when(met, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, leaf: int, path: frozenset[Condition] = frozenset()) -> list[frozenset[Condition]]:
    """Paths to all nodes below the root of a tree that splits by Gini impurity on random statistics."""
    here = [path] if path else []
    if depth == 0 or len(y) < 2 * leaf or y.min() == y.max():
        return here
    best = (1e-9, None, None)
    for k in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
        limits = np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 25)))
        low = x[:, k][:, None] <= limits
        n, ones = low.sum(0), (low * y[:, None]).sum(0)
        m, rest = len(y) - n, y.sum() - ones
        good = (n >= leaf) & (m >= leaf)
        gain = len(y) * y.mean() * (1 - y.mean()) - ones * (1 - ones / np.maximum(1, n)) - rest * (1 - rest / np.maximum(1, m))
        gain[~good] = 0
        if len(gain) and gain.max() > best[0]:
            best = gain.max(), int(k), float(limits[gain.argmax()])
    if best[1] is None:
        return here
    _, k, limit = best
    below = x[:, k] <= limit
    return here + [p for side, above in ((below, False), (~below, True)) for p in _paths(x[side], y[side], rng, depth - 1, leaf, path | {(k, above, limit)})]


def _lasso(full: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic regression with an L1 penalty (accelerated proximal steps).

    The first column of ``full`` is ones; the matrix is never copied, as it is the largest thing that the driver holds.
    """
    n, m = full.shape
    rate = 4 * n / np.linalg.eigvalsh(full.T @ full)[-1]
    w = v = np.zeros(m)
    t = 1.0
    for _ in range(steps):
        step = v - rate * (full.T @ (1 / (1 + np.exp(-(full @ v))) - y)) / n
        step[1:] = np.sign(step[1:]) * np.maximum(0, np.abs(step[1:]) - rate * penalty)
        ahead = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = step + (t - 1) / ahead * (step - w), step, ahead
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 1e-3, seed: int = 5) -> Rules:
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 0.5
    if not len(y) or y.min() == y.max():
        return Rules(float(np.log(share / (1 - share))), [])
    rng, rules = np.random.default_rng(seed), {}
    for _ in range(trees):
        some = rng.integers(0, len(y), len(y))
        rules |= dict.fromkeys(_paths(x[some], y[some], rng, depth, max(5, len(y) // 200)))
    rules = list(rules)
    met = np.ones((len(y), 1 + len(rules)))
    for j, rule in enumerate(rules, 1):
        for k, above, limit in rule:
            met[:, j] *= (x[:, k] > limit) == above
    intercept, weights = _lasso(met, y, penalty)
    return Rules(intercept, [(rule, float(w)) for rule, w in zip(rules, weights, strict=True) if w])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", per_class: int = 3000) -> Rules:
    """Learn from the labelled rows that aren't held out."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    bound = F.when(F.col("_label") == 1, hash_bound(counts.get(1, 0), per_class)).otherwise(hash_bound(counts.get(0, 0), per_class))
    known = known.where(F.xxhash64("_id") <= bound).withColumn("row", F.expr("row_number() over (partition by _label order by xxhash64(_id), _id)")).where(f"row <= {per_class}").drop("row").distinct()
    # at most 2 * per_class rows of two integers
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(known), F.col(id_col) == F.col("_id"))
    rows = rows.withColumn("row", F.expr("row_number() over (partition by _id, _label order by xxhash64(text))")).where("row = 1")
    found = measured(rows.select("_label", "text")).toPandas()
    y = found["_label"].to_numpy(float)
    x = found[list(STATISTICS)].to_numpy(float)
    if len(y) and 0 < y.sum() < len(y):
        # the classes' shares among all labels, by repeating rows of the larger one
        want = counts.get(1, 0) / max(1, counts.get(0, 0)) / (y.sum() / (len(y) - y.sum()))
        times = np.where(y == (1 if want > 1 else 0), max(1, round(max(want, 1 / want))), 1)
        x, y = np.repeat(x, times, 0), np.repeat(y, times)
    return fit_rules(x, y)


def score(docs: DataFrame, rules: Rules, text: str = "text", id_col: str = "doc_id", limit: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    done = measured(rows).withColumn("score", rules.score())
    return done.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def accepted(docs: DataFrame, rules: Rules, text: str = "text", limit: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``limit`` or more, unchanged."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    kinds = docs.schema.fields
    rows = docs.toDF(*own).withColumn("_text", F.coalesce(F.col(own[docs.columns.index(text)]), F.lit("")))
    kept = measured(rows, "_text").where(rules.score() >= limit)
    return kept.select(*[F.col(c).cast(k.dataType).alias(k.name) for c, k in zip(own, kinds, strict=True)])
