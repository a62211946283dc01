"""Near duplicates against brute-force Jaccard."""

import random

import numpy as np
import pytest

import corpus_pipeline
from keelstone.llm import simhash
from tests.llm.conftest import ODD
from tests.llm.test_text_operators import WORD


def shingles_of(text, k=5):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()


def groups_of(texts, least=0.8):
    sets, parent = [shingles_of(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= least * len(a | sets[j]) - 1e-9:
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in range(len(texts))}


def edited_texts():
    rng = random.Random(11)
    out = []
    for _ in range(60):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(8, 200))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            w = list(base)
            for _ in range(rng.randint(1, 1 + len(w) // 20)):
                w[rng.randrange(len(w))] = "Edited"
            out.append(" ".join(w))
    rng.shuffle(out)
    return out + ODD


@pytest.mark.parametrize("bucket_rows, crowd", [(3, 100), (2000, simhash.CROWD)])
def test_groups_by_similarity(docs, bucket_rows, crowd):
    texts = edited_texts()
    rows = simhash.similar(docs(texts), bucket_rows=bucket_rows, crowd=crowd).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == groups_of(texts)
    assert simhash.similar(docs(texts).where("false")).count() == 0


def test_pairs_at_the_least_similarity_meet():
    """Sets at similarity 0.8 share a bucket of some part and pass the tests of distance in at least 98 of 100 cases."""
    rng = np.random.default_rng(8)
    masks = np.array([m & (1 << 64) - 1 for m in simhash.covering_masks(3, 11, simhash.PART_BITS)], np.uint64)
    met = wide = 0
    for _ in range(600):
        n = 9 * int(rng.integers(1, 600 if rng.random() < 0.5 else 8))
        base = rng.integers(0, 1 << 64, n, np.uint64)
        other = base.copy()
        other[: n // 9] = rng.integers(0, 1 << 64, n // 9, np.uint64)
        long = simhash._longs(simhash._wide(np.concatenate([base, other]), np.array([0, n, 2 * n])))
        low, far = simhash._parts(long)
        apart = (low[0] ^ low[1]).view(np.uint64)
        assert not (apart >> np.uint64(simhash.PART_BITS) & np.uint64(63)).any()
        total = np.bitwise_count(apart) + int(np.bitwise_count((far[0] ^ far[1]).view(np.uint64)))
        met += bool((((apart[:, None] & masks) == 0).any(1) & (total <= simhash.NEAR_RADIUS)).any())
        wide += int(np.bitwise_count((long[0] ^ long[1]).view(np.uint64)).sum()) <= simhash.WIDE_RADIUS
    assert met >= 588 and wide >= 597, (met, wide)


def test_stage_drops_near_copies_and_nothing_below(spark, docs):
    texts = edited_texts()
    out = corpus_pipeline.near_dedup_stage(spark, docs([*enumerate(texts), (None, texts[0])]), "")
    assert sorted(r["doc_id"] for r in out.where("doc_id is not null").collect()) == sorted(set(groups_of(texts).values()))
    assert out.where("doc_id is null").count() == 1


def test_stage_tells_equal_ids_apart_by_text(spark, docs):
    rng = random.Random(2)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = [(1, a), (1, b), (2, a), (1, a), (3, b + " more"), (3, c), (4, None), (4, None), (5, "")]
    out = corpus_pipeline.near_dedup_stage(spark, docs(rows), "")
    assert sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == sorted([(1, a), (1, b), (3, c), (4, "")])
