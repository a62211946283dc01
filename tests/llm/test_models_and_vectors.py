"""Learned operators by held-out accuracy, vectors against brute force, and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keelstone.llm import embedding_dedup, language, quality
from keelstone.llm import queries as llm
from keelstone.llm.common import documents, staged
from tests.llm.conftest import ODD


def test_language_held_out(spark, data):
    rows = llm.op4_language_id(spark, data).join(documents(spark, data).select("doc_id", "lang", "text"), "doc_id").collect()
    out = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["text"] is None or not any(c.isalpha() for c in r["text"]))


def test_language_of_odd_texts(spark, docs, data):
    model = language.fit(documents(spark, data))
    rows = language.identify(docs(ODD + ["the thing of the and that was with"]), model=model).collect()
    for r in rows:
        t = (ODD + ["the"])[r["doc_id"]]
        assert (r["lang_pred"] == "und") == (t is None or not any(c.isalpha() for c in t)) and 0 <= r["score"] <= 1
    assert rows and {r["lang_pred"] for r in language.identify(docs(["abc"]).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(docs(["a"]).where("false"), model=model).count() == 0


def test_language_of_whole_tables_by_a_plain_scorer(spark, data):
    docs = documents(spark, data)
    model = language.fit(docs)
    got = {r["doc_id"]: r for r in llm.op4_language_id(spark, data).collect()}

    def fold(b):
        return b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32

    for i, t in docs.select("doc_id", "text").collect():
        if t is None or not any(c.isalpha() for c in t):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        b, x = [fold(c) for c in t.encode()], np.zeros(language.WIDTH)
        for size, base, width in ((2, 0, language.PAIRS), (3, language.PAIRS, language.TRIPLES)):
            cells = Counter()
            for j in range(len(b) - size + 1):
                if any(c != 32 for c in b[j : j + size]):
                    cells[((int.from_bytes(b[j : j + size], "big") * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 40) % width] += 1
            for cell, n in cells.items():
                x[base + cell] = math.sqrt(n / sum(cells.values()) / 2)
        margin = [float(w[:-1] @ x + w[-1]) for w in model.weights]
        k = len(model.families)
        family = max(range(k), key=lambda f: margin[f])
        votes, sure = {}, {}
        for n, lang in enumerate(model.langs):
            if model.member[n] == family:
                own = [(m if n == p else -m) for (p, q), m in zip(model.pairs, margin[k:], strict=True) if n in (p, q)]
                chance = [1 / (1 + math.exp(-4 * m)) for m in own]
                votes[lang] = sum(m > 0 for m in own) + sum(chance) / 8
                sure[lang] = sum(chance) / len(own) if own else 1.0
        best = max(votes, key=votes.get)
        assert got[i]["lang_pred"] == best and got[i]["score"] == pytest.approx(sure[best] / (1 + math.exp(-4 * margin[family])) if k > 1 else sure[best], abs=1e-6), i


def test_quality_of_whole_tables_by_a_plain_scorer(spark, data):
    docs = documents(spark, data)
    rules = quality.fit(docs, spark.read.parquet(f"{data}/labels.parquet"))
    got = {r["doc_id"]: r for r in llm.op5_quality(spark, data).collect()}
    letter, marks, symbols = re.compile(rb"[A-Za-z\x80-\xff]"), set(b"!\"'(),-.:;?"), set(b"#$%&*+/<=>@[\\]^_`{|}~")

    def most(values):
        return max(Counter(values).values(), default=0)

    for i, t in docs.select("doc_id", "text").collect():
        raw = (t or "").encode()
        w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        letters = letter.findall(raw)
        lines = [x for x in re.findall(rb"[^\n]*\n|[^\n]+", raw)]
        n, m = max(1, len(raw)), max(1, len(w))
        s = {
            "bytes": len(raw), "words": len(w), "word_bytes": sum(c > 32 for c in raw) / m, "longest_word": max(map(len, w), default=0), "letters": len(letters) / n,
            "upper": sum(65 <= c <= 90 for c in raw) / max(1, len(letters)), "digits": sum(48 <= c <= 57 for c in raw) / n, "symbols": sum(c in symbols for c in raw) / n,
            "marks": sum(c in marks for c in raw) / n, "distinct": len(set(w)) / m, "commonest": most(w) / m, "distinct_pairs": len(set(zip(w, w[1:]))) / max(1, len(w) - 1),
            "lines": len(lines), "line_words": len(w) / max(1, len(lines)), "repeated_lines": (len(lines) - len(set(lines))) / max(1, len(lines)),
            "bare_words": sum(not letter.search(x) for x in w) / m, "ended_words": sum(not letter.match(x[-1:]) for x in w) / m, "capital_words": sum(65 <= x[0] <= 90 for x in w) / m,
        }
        x = [s[k] for k in quality.STATISTICS]
        total = rules.intercept + sum(weight for rule, weight in rules.weights if all((x[k] > limit) == above for k, above, limit in rule))
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9), (i, s)


def test_a_pair_of_one_family():
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(60, language.WIDTH)))
    x[:30, 5] += 9
    m = language.Model(np.array(["fr"] * 30 + ["es"] * 30, object), x)
    assert len(m.families) == 1 and (np.array(m.langs)[m.predict(x)[0]] == np.array(["fr"] * 30 + ["es"] * 30)).all()


def test_quality_held_out(spark, data):
    rows = llm.op5_quality(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.9 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_texts_and_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rules = quality.fit(docs(ODD), labels)
    rows = quality.score(docs(ODD), rules).collect()
    assert len(rows) == len(ODD) and all(math.isclose(r["score"], 0.5) for r in rows)
    one = quality.fit(docs(ODD), spark.createDataFrame([(i, 1) for i in range(len(ODD))], "doc_id long, quality int"))
    assert quality.accepted(docs(ODD), one).count() == len(ODD)
    assert quality.score(docs(["a"]).where("false"), rules).count() == 0


def test_rules_are_the_expression(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(quality.STATISTICS)))
    y = ((x[:, 4] > 0.5) & (x[:, 9] < 0.7)).astype(float)
    rules = quality.fit_rules(x, y, trees=10)
    df = spark.createDataFrame(x.tolist(), ", ".join(f"{s} double" for s in quality.STATISTICS)).select(rules.score().alias("s"))
    total = np.full(len(x), rules.intercept)
    for rule, w in rules.weights:
        total += w * np.all([(x[:, k] > t) == above for k, above, t in rule], axis=0)
    got = np.array([r["s"] for r in df.collect()])
    assert np.allclose(sorted(got), sorted(1 / (1 + np.exp(-total)))) and ((1 / (1 + np.exp(-total)) > 0.5) == y).mean() > 0.95


def test_statistics_of_texts():
    texts = ["", "a b a B1.\na b a B1.\n\nx!", "ÄÖ $$ 12"]
    raw = [t.encode() for t in texts]
    x = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    s = {k: x[:, i].tolist() for i, k in enumerate(quality.STATISTICS)}
    assert s["bytes"] == [0, len(raw[1]), len(raw[2])] and s["words"] == [0, 9, 3] and s["longest_word"] == [0, 3, 4]
    assert s["lines"] == [0, 3, 1] and s["repeated_lines"][1] == pytest.approx(1 / 3)
    assert s["distinct"][1] == pytest.approx(4 / 9) and s["commonest"][1] == pytest.approx(4 / 9)


def brute(rows, threshold):
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    good = [(i, np.array(v, float), label) for i, v, label in rows if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    pairs = 0
    for k, (i, v, a) in enumerate(good):
        for j, w, b in good[k + 1 :]:
            if a == b and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                links[i] += 1
                links[j] += 1
                pairs += 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return links, {i: root(i) for i in links}, pairs


@pytest.mark.parametrize("leaf_rows", [8, 512])
def test_embeddings(spark, leaf_rows):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(25, 16))
    rows = []
    for i in range(300):
        v = (centres[i % 25] + rng.normal(size=16) * rng.choice([0.05, 0.3])).astype(np.float32)
        rows.append((i, v.tolist(), int(i % 25 % 3)))
    crowd = rng.normal(size=16)
    rows += [(300 + i, (crowd + rng.normal(size=16) * 0.02).astype(np.float32).tolist(), 1) for i in range(60)]
    rows += [(400 + i, rows[0][1], rows[0][2]) for i in range(20)] + [(500, rows[0][1], 2), (501, rows[0][1], None)]
    rows += [(502, None, 1), (503, [], 1), (504, [0.0] * 16, 1), (505, [None] * 16, 1), (506, [float("nan")] * 16, 1), (507, [1.0] * 3, 1), (508, [1.0] * 3, 1), (509, [float("inf")] + [1.0] * 15, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table, leaf_rows=leaf_rows).collect()}
    links, roots, pairs = brute(rows, 0.93)
    assert all(got[i]["n_links"] <= n for i, n in links.items())
    assert sum(r["n_links"] for r in got.values()) / 2 >= 0.95 * pairs
    assert sum(got[i]["component_id"] == c for i, c in roots.items()) >= 0.95 * len(roots)
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert embedding_dedup.near_duplicates(table.where("false")).count() == 0


@pytest.mark.parametrize("width", [64, 384, 768])
def test_the_forest_splits_one_large_label(spark, tmp_path, width):
    """21,000 vectors of one label: leaves are small, and pairs near the threshold share one."""
    rng = np.random.default_rng(width)
    n, pairs = 21_000, 1_000
    x = rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(pairs, width))
    side -= (side * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.932, 0.95, (pairs, 1))
    x[pairs : 2 * pairs] = cosine * x[:pairs] + np.sqrt(1 - cosine**2) * side
    rows = pa.table({"id": np.arange(n), "root": np.zeros(n, np.int64), "copies": np.ones(n, np.int64), "vector": pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).ravel()), width).cast(pa.list_(pa.float32()))})
    pq.write_table(rows, tmp_path / "vectors.parquet")
    vectors = spark.read.parquet(str(tmp_path / "vectors.parquet")).repartition(8)
    leaves = staged(embedding_dedup.forest(vectors, 6, 512, 0.16, 2048), "leaves")
    assert leaves.agg(F.max("n")).first()[0] <= 512 and leaves.select("tree", "node").distinct().count() > 6 * n // 512
    links = embedding_dedup.link(vectors, leaves, 0.93, 2048).where("b is not null").select(F.least("a", "b"), F.greatest("a", "b")).distinct().collect()
    assert len(links) >= 0.99 * pairs and all(b == a + pairs for a, b in links)


def test_embeddings_of_the_driver(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r["vec_id"]: r["n_links"] for r in llm.op6_embedding_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert got == brute(rows, 0.93)[0]


def test_pipeline(spark, data):
    docs = documents(spark, data)
    labels = spark.read.parquet(f"{data}/labels.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, data).cache()
    scores = {r["doc_id"]: r["predicted"] for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, p in scores.items() if p}
    assert kept.schema == docs.schema
    rows = dict(kept.select("doc_id", "text").collect())
    one = corpus_pipeline.near_dedup_stage(spark, kept, data).cache()
    from tests.llm.test_similar import groups_of

    ids = sorted(rows)
    assert {r["doc_id"] for r in one.collect()} == {ids[i] for i in groups_of([rows[i] for i in ids]).values()}
    cut = corpus_pipeline.passage_dedup_stage(spark, one, data)
    assert cut.schema == docs.schema and cut.count() == one.count()
    assert corpus_pipeline.mixing_stage(spark, cut, data).schema == docs.schema
    done = corpus_pipeline.run(spark, data)
    assert done.where("n_tokens = 0").count() == 0 and done.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "mixing", "byte_bpe"]


@pytest.mark.parametrize("case", ["odd", "empty"])
def test_every_stage_of_odd_and_empty_tables(spark, docs, data, case):
    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60_000))
    rows = docs([*enumerate(ODD), (None, "no id"), (None, None), (3, "x"), (3, "another text"), (90, long), (91, long[100_000:])])
    rows = rows.withColumn("source", F.when(F.col("doc_id") % 4 == 0, None).otherwise(F.col("source")))
    rows = rows.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, None).otherwise(F.col("lang"))).withColumn("id", F.lit("extra")).withColumn("node", F.lit(1)).withColumn("gone_id", F.lit(2))
    if case == "empty":
        rows = rows.where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, rows, data), "stage")
        assert out.columns == rows.columns and [f.dataType for f in out.schema] == [f.dataType for f in rows.schema], name
        before = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
        after = out.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
        if name != "mixing":
            assert after[0] <= before[0] and (after[1] or 0) <= (before[1] or 0), name
        # the quality rules may reject odd texts, so the other stages take them all
        rows = rows if name == "quality_classifier" else out
    done = corpus_pipeline.STAGES[-1][1](spark, rows, data)
    assert done.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert (done.count() == 0) == (case == "empty")


def test_clashing_columns(spark, docs):
    rng = random.Random(1)
    rows = docs([" ".join(rng.choices("abc def ghi".split(), k=60)) for _ in range(12)])
    for c in ("id", "size", "taken", "c0", "_text", "kept", "fp", "words", "lines", "row", "bucket", "left", "pass"):
        rows = rows.withColumn(c, F.lit(1))
    own = rows.columns
    from keelstone.llm import bpe, fingerprint, mixing, sharding, simhash, substring_dedup, suffix_dedup

    for f in (suffix_dedup.remove_repeats, substring_dedup.remove_repeats, simhash.near_duplicates, sharding.shard, fingerprint.fingerprints, mixing.mix, bpe.encode):
        assert f(rows).count() == 12, f
    vectors = rows.withColumn("embedding", F.array(F.lit(1.0), F.col("doc_id").cast("double"))).withColumn("label", F.lit(1)).withColumnRenamed("doc_id", "vec_id")
    for c in ("root", "copies", "tree", "node", "vector", "rep", "a", "b", "n"):
        vectors = vectors.withColumn(c, F.lit(1))
    assert embedding_dedup.near_duplicates(vectors).count() == 12 and simhash.similar(rows).count() == 12
    assert mixing.mixed(rows).columns == own and quality.accepted(rows, quality.Rules(9.0, [])).columns == own
    assert language.identify(rows).count() == 12 and quality.score(rows, quality.Rules(0.0, [])).count() == 12


def test_hash_bound_keeps_enough_rows(spark):
    from pyspark.sql import functions as F

    from keelstone.llm.common import hash_bound

    assert hash_bound(0, 800) == hash_bound(3200, 800) == (1 << 63) - 1
    kept = spark.range(100_000).where(F.xxhash64("id") <= hash_bound(100_000, 800)).count()
    assert 2900 < kept < 3500
