"""Near-duplicate embeddings from a forest of random-projection trees with spill overlap.

Vectors with one label start together in every tree.  A node with more than ``leaf_rows`` vectors is split
by random directions at the median of a bounded sample of it (``sample_rows``, chosen by hash), several
levels at a time; a vector within ``spill`` of a threshold goes to both sides.  Projections of unit vectors of d
dimensions lie within about 1 / sqrt(d) of each other, so ``spill`` is given as a multiple of that.  A direction that would put
more than ``MOST_SHARED`` on both sides isn't used, and the next one is tried.  The sample only places the thresholds: every
vector is routed, and nodes are split until they are small.  A node that no longer shrinks, although several directions were tried, is a
dense cluster, whose vectors are so close (a cosine of about 0.87 between most) that splitting would cost more comparisons than it saves.
It is compared in blocks of ``block_rows`` that other tasks share, two at a time; as all its links have to be counted, that is all pairs of it.

Within a leaf all cosines are computed.  A linked pair counts in the first leaf that it shares, known from
the lists of leaves that travel with the vectors, so counts need no list of pairs.  Links leave a leaf as
stars.  Equal vectors of a label are one class throughout and are never paired with one another.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those with a
null label, link with nothing and are kept; vectors of unequal length don't link; repeated rows are copies
that count as links of each other; rows with a null id form no links and have a null component; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import components, staged

_MASK = (1 << 63) - 1

#: A split that would send more of a node to both sides isn't made; the next direction may do better.
#: With a share s on both sides, leaves hold less than all pairs only if (1 + s)**2 is below 2.
MOST_SHARED = 0.35


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    return np.asarray(column.flatten()).astype(float).reshape(len(column), -1)


def _planes(tree: int, node: int, count: int, width: int) -> np.ndarray:
    planes = np.random.default_rng([tree, node & _MASK]).standard_normal((count, width))
    return planes / np.linalg.norm(planes, axis=1, keepdims=True)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _child(node: int, leaf: np.ndarray) -> np.ndarray:
    h = (np.uint64(node & ((1 << 64) - 1)) ^ (leaf.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _split(x: np.ndarray, planes: np.ndarray, spill: float, cuts: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of each leaf of a complete tree, and its thresholds (medians of ``x`` if none are given)."""
    fit, spill = cuts is None, spill / np.sqrt(x.shape[1])
    cuts = np.zeros(len(planes)) if fit else cuts
    level = [np.arange(len(x))]
    at = 0
    while at < len(planes):
        below = []
        for rows in level:
            t = x[rows] @ planes[at]
            if fit:
                cuts[at] = np.median(t) if len(rows) else np.nan
                if (np.abs(t - cuts[at]) <= spill).mean() > MOST_SHARED:
                    cuts[at] = np.nan
            if np.isnan(cuts[at]):
                below += [rows, rows[:0]]
            else:
                below += [rows[t <= cuts[at] + spill], rows[t >= cuts[at] - spill]]
            at += 1
        level = below
    return level, cuts


def forest(vectors: DataFrame, trees: int, leaf_rows: int, spill: float, sample_rows: int) -> DataFrame:
    """(id, tree, node, n): the leaves of each of ``vectors`` (id, root, vector), with their sizes."""

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        tree, node, n = (k.as_py() for k in key)
        x = _units(_matrix(table.column("vector").combine_chunks()))
        # a level leaves about 0.57 of a node's rows on a side; one direction more, should one not serve
        depth = min(6, 1 + int(np.ceil(np.log(n / leaf_rows) / 0.56)))
        _, cuts = _split(x, _planes(tree, node, (1 << depth) - 1, x.shape[1]), spill, None)
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": [node], "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, node = batch.column("tree").to_numpy(), batch.column("node").to_numpy()
            order = np.lexsort((node, tree))
            first = np.flatnonzero(np.concatenate([[True], (tree[order][1:] != tree[order][:-1]) | (node[order][1:] != node[order][:-1])])[: len(order)])
            for i, j in zip(first, np.append(first, len(order))[1:], strict=True):
                some = batch.take(pa.array(order[i:j]))
                cuts = np.array(some.column("cuts")[0].as_py())
                x = _units(_matrix(some.column("vector")))
                leaves, _ = _split(x, _planes(int(tree[order[i]]), int(node[order[i]]), len(cuts), x.shape[1]), spill, cuts)
                rows = np.concatenate(leaves)
                leaf = np.repeat(np.arange(len(leaves)), [len(r) for r in leaves])
                out = some.take(pa.array(rows))
                child = pa.array(_child(int(node[order[i]]), leaf))
                yield pa.RecordBatch.from_arrays([out.column("id"), out.column("tree"), child, out.column("n")], ["id", "tree", "node", "parent"])

    rows = vectors.select("id", F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"), F.col("root").alias("node"), F.lit(_MASK).alias("parent"))
    done = None
    while True:
        sizes = rows.groupBy("tree", "node").agg(F.count("*").alias("n"), F.min("parent").alias("parent"))
        sized = rows.drop("parent").join(sizes, ["tree", "node"])
        ends = F.expr(f"n <= {leaf_rows} or n > 0.8 * parent")
        final = sized.where(ends).select("id", "tree", "node", "n")
        done = final if done is None else done.unionByName(final)
        over = sized.where(~ends)
        if sizes.where(~ends).isEmpty():
            return done
        big = over.select("id", "tree", "node", "n").join(vectors.select("id", "vector"), "id")
        chosen = big.withColumn("row", F.expr("row_number() over (partition by tree, node order by xxhash64(id, tree))")).where(f"row <= {sample_rows}")
        fitted = chosen.groupBy("tree", "node", "n").applyInArrow(fit, "tree int, node long, cuts array<double>")
        rows = staged(big.join(fitted, ["tree", "node"]).mapInArrow(route, "id long, tree int, node long, parent long").distinct(), "forest")


#: Rows of a block that are compared with all of it at once.
_ROWS = 512


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the first row that it is connected with."""
    low = np.arange(n)
    while len(i):
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if (low == before).all():
            break
    return low


def link(vectors: DataFrame, leaves: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """(a, b, n): with b null, n linked vectors more for class a; else an edge between a and b."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        tree, node, p, q = (k.as_py() for k in key)
        x = _units(_matrix(table.column("vector").combine_chunks()))
        ids, copies, block = (table.column(c).to_numpy() for c in ("id", "copies", "block"))
        # a pair is counted in the first leaf that both are in: none before this one may be common
        leaves = table.column("leaves").combine_chunks()
        who = np.repeat(np.arange(len(ids)), np.diff(leaves.offsets.to_numpy()))
        parts = leaves.flatten().flatten()
        trees, nodes = parts[0].to_numpy(), parts[1].to_numpy()
        before = (trees < tree) | ((trees == tree) & (nodes < node))
        column = np.unique(np.stack([trees[before], nodes[before]]), axis=1, return_inverse=True)[1].ravel()
        member = np.zeros((len(ids), int(column.max()) + 1 if len(column) else 1), np.float32)
        member[who[before], column] = 1
        count, low = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for at in range(0, len(ids), _ROWS):
            near = x[at : at + _ROWS] @ x.T >= threshold
            near &= np.arange(at, min(at + _ROWS, len(ids)))[:, None] < np.arange(len(ids))
            if p != q:
                near &= block[at : at + _ROWS, None] != block
            i, j = np.nonzero(near)
            new = (member[at : at + _ROWS] @ member.T)[i, j] == 0
            i += at
            np.add.at(count, i[new], copies[j[new]])
            np.add.at(count, j[new], copies[i[new]])
            tied = np.flatnonzero(low != np.arange(len(ids)))
            low = _spanning(len(ids), np.concatenate([i, tied]), np.concatenate([j, low[tied]]))
        some, tied = np.flatnonzero(count), np.flatnonzero(low != np.arange(len(ids)))
        return pa.table(
            {
                "a": pa.array(np.concatenate([ids[some], ids[tied]]), pa.int64()),
                "b": pa.array([None] * len(some) + ids[low[tied]].tolist(), pa.int64()),
                "n": pa.array(np.concatenate([count[some], np.zeros(len(tied), np.int64)]), pa.int64()),
            }
        )

    lists = leaves.groupBy("id").agg(F.collect_set(F.struct("tree", "node")).alias("leaves"))
    rows = leaves.where("n > 1").join(vectors.select("id", "vector", "copies").join(lists, "id"), "id")
    rows = rows.withColumn("blocks", F.expr(f"cast((n + {block_rows - 1}) div {block_rows} as int)")).withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    rows = rows.select("tree", "node", "p", "q", "id", "copies", "block", "vector", "leaves")
    return rows.groupBy("tree", "node", "p", "q").applyInArrow(compare, "a long, b long, n long")


def near_duplicates(
    table: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label", threshold: float = 0.93,
    trees: int = 6, leaf_rows: int = 512, spill: float = 0.16, sample_rows: int = 2048, block_rows: int = 2048,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; ``id_col`` must be an integer column."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    good = F.expr("id is not null and label is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vector, x -> x <> 0)")
    fit = rows.where(F.coalesce(good, F.lit(False)))
    classes = fit.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    # the smallest id of two classes can be the same only if rows repeat an id with another vector
    vectors = staged(classes.select(F.col("rep").alias("id"), F.xxhash64("label", F.size("vector")).alias("root"), "vector", "copies"), "vectors")
    leaves = staged(forest(vectors, trees, leaf_rows, spill, sample_rows), "leaves")
    found = staged(link(vectors, leaves, threshold, block_rows), "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    named = components(found.where("b is not null"))
    info = vectors.select("id", "copies").join(counts, F.col("id") == F.col("a"), "left").join(named, F.col("id") == F.col("node"), "left")
    info = info.select(F.col("id").alias("rep"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    member = fit.select("id", "label", "vector").join(classes.select("label", "vector", "rep"), ["label", "vector"]).select("id", "rep")
    linked = member.join(info, "rep").select("id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(good, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(rest)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
