"""A passage in very many documents: no anchor is resolved whole, and results stay those of brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from keelstone.llm import passages, substring_dedup, suffix_dedup

LIMIT = 60


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(passages, "PIECE", LIMIT)
    monkeypatch.setattr(passages, "SAMPLED", 1, raising=False)
    for module in (suffix_dedup, substring_dedup):
        plain = module.resolver

        def checked(length, plain=plain):
            resolve = plain(length)

            def run(e):
                assert len(e) <= LIMIT, len(e)
                return resolve(e)

            return run

        monkeypatch.setattr(module, "resolver", checked)


def around(passage, n=300, words=30):
    """Texts that share ``passage``, and now and then what stands before or after it."""
    rng = random.Random(4)

    def prose(k):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(k))

    near = [prose(4) for _ in range(5)]
    out = []
    for i in range(n):
        left, right = (rng.choice(near) if rng.random() < 0.3 else prose(4) for _ in range(2))
        out.append(f"{prose(words)} {left} {passage} {right} {prose(words)}" + (f" {left}  {passage}" if i % 50 == 0 else ""))
    return out


def test_suffix_dedup(docs, small):
    texts = around("".join(random.Random(5).choices("klmnopqrst", k=500)))
    seen, want = {}, {}
    raw = [t.encode() for t in texts]
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 49):
            if seen.setdefault(b[j : j + 50], i) < i:
                gone[j : j + 50] = True
        want[i] = bytes(np.frombuffer(b, np.uint8)[~gone])
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs(texts)).collect()}
    assert got == want


def test_substring_dedup(docs, small):
    rng = random.Random(6)
    texts = around(" ".join(f"p{rng.randrange(10**6)}" for _ in range(70)), words=45)
    own = [t.split() for t in texts]
    count = Counter(tuple(w[j : j + 35]) for w in own for j in range(len(w) - 34))
    want = {}
    for i, w in enumerate(own):
        gone = set()
        for j in range(len(w) - 34):
            if count[tuple(w[j : j + 35])] > 1:
                gone.update(range(j, j + 35))
        want[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    assert {r["doc_id"]: r["kept"] for r in substring_dedup.remove_repeats(docs(texts)).collect()} == want
