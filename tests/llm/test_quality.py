"""The quality classifier: features, updates and held-out accuracy."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from runlens.llm import quality
from runlens.llm._words import ngram_hashes, words_of


def corpus(rng, n):
    """Good texts are varied prose; bad ones repeat words or wear signs."""
    letters = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(letters) for _ in range(rng.randrange(20, 60))]
        good = rng.random() < 0.7
        if not good:
            words = [w for w in words[:8] for _ in range(6)] if rng.random() < 0.5 else [w + rng.choice(["%%%", "&&&"]) for w in words]
        rows.append((i, " ".join(words), int(good)))
    return rows


def test_words():
    texts = ["Ab  c\tAB", None, "", "x\ny", " ", "é É a"]
    w = words_of(pa.array(texts))
    vocabulary = w.vocabulary.to_pylist()
    got = [[vocabulary[c].decode() for c in w.codes[w.bounds[i] : w.bounds[i + 1]]] for i in range(len(texts))]
    assert got == [["ab", "c", "ab"], [], [], ["x", "y"], [], ["é", "É", "a"]]
    h, first = ngram_hashes(w.hashes(), w.bounds, 2)
    assert first.tolist() == [0, 1, 3, 5, 6]
    assert len(words_of(pa.array([None, ""])).codes) == 0
    sliced = words_of(pa.array(["zzz", "b a", "c"]).slice(1, 2))
    assert sliced.bounds.tolist() == [0, 2, 3]


def test_features_do_not_depend_on_neighbours():
    texts = ["a b c a b", None, "a b c a b", "", "x"]
    alone = [next(quality.features(pa.array([t], pa.string()))) for t in texts]
    (bounds, slots, values), = quality.features(pa.array(texts))
    for i, (b, s, v) in enumerate(alone):
        assert slots[bounds[i] : bounds[i + 1]].tolist() == s.tolist() and np.allclose(values[bounds[i] : bounds[i + 1]], v)
        assert abs(float((v.astype(float) ** 2).sum()) - (1 if texts[i] else 0)) < 1e-5


def test_ftrl_against_a_plain_loop():
    """The vectorised updates equal the textbook's per-coordinate ones."""
    rng = np.random.default_rng(3)
    learner = quality.Ftrl(4, alpha=0.5, beta=1.0, l1=0.05, l2=0.3)
    z, n = [0.0] * 16, [0.0] * 16
    zb = nb = 0.0
    for _ in range(80):
        slots = np.sort(rng.choice(16, 5, replace=False))
        values, label = rng.random(5), int(rng.integers(2))
        w = {}
        for s in slots:
            w[s] = 0.0 if abs(z[s]) <= 0.05 else -(z[s] - np.sign(z[s]) * 0.05) / ((1.0 + n[s] ** 0.5) / 0.5 + 0.3)
        bias = -zb / ((1.0 + nb**0.5) / 0.5)
        p = 1 / (1 + np.exp(-(sum(w[s] * v for s, v in zip(slots, values, strict=True)) + bias)))
        for s, v in zip(slots, values, strict=True):
            g = (p - label) * v
            z[s] += g - ((n[s] + g * g) ** 0.5 - n[s] ** 0.5) / 0.5 * w[s]
            n[s] += g * g
        d = p - label
        zb += d - ((nb + d * d) ** 0.5 - nb**0.5) / 0.5 * bias
        nb += d * d
        learner.update(slots.astype(np.uint32), values, label)
    assert np.allclose(learner.z, z) and np.allclose(learner.n, n)


MASK = (1 << 64) - 1


def plain_features(text, bits):
    """{slot: value} of a text's hashed n-grams of words and of shapes, one at a time."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shapes = []
    for i, w in enumerate(words):
        kind = re.sub(r"\d+", "0", re.sub(r"[^\W\d_]+", "a", w.decode("utf-8", "replace")))
        shapes.append(0x5851F42D4C957F2D if i and words[i - 1] == w else xxhash.xxh64_intdigest(b"\0" + kind.encode()))
    counts = {}
    for stream, sizes in (([xxhash.xxh64_intdigest(w) for w in words], (1, 2)), (shapes, (1, 2, 3))):
        for size in sizes:
            for i in range(len(stream) - size + 1):
                h = stream[i]
                for x in stream[i + 1 : i + size]:
                    h = ((h ^ (h >> 29)) * 0x9E3779B97F4A7C15 + x) & MASK
                h ^= h >> 32
                slot = (h * (2 * size + 1) & MASK) >> (64 - bits)
                counts[slot] = counts.get(slot, 0) + 1
    values = {s: math.log1p(c) for s, c in counts.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {s: v / length for s, v in values.items()}


def plain_model(rows, bits=18, epochs=2, alpha=4.0, beta=1.0, l1=0.1):
    """Weights {slot: w} and bias by the textbook's updates, one coordinate at a time; rows are (text, label) in the order of training."""
    z, n, zb, nb = {}, {}, 0.0, 0.0

    def weight(s):
        return 0.0 if abs(z.get(s, 0.0)) <= l1 else -(z[s] - math.copysign(l1, z[s])) / ((beta + math.sqrt(n[s])) / alpha)

    made = [(plain_features(t, bits), y) for t, y in rows]
    rng = np.random.default_rng(1)
    for _ in range(epochs):
        for i in rng.permutation(len(made)):
            values, label = made[i]
            w, bias = {s: weight(s) for s in values}, -zb / ((beta + math.sqrt(nb)) / alpha)
            d = 1 / (1 + math.exp(-(sum(w[s] * v for s, v in values.items()) + bias))) - label
            for s, v in values.items():
                g, old = d * v, n.get(s, 0.0)
                z[s] = z.get(s, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[s]
                n[s] = old + g * g
            zb += d - (math.sqrt(nb + d * d) - math.sqrt(nb)) / alpha * bias
            nb += d * d
    return {s: weight(s) for s in z}, -zb / ((beta + math.sqrt(nb)) / alpha)


def plain_score(text, weights, bias, bits=18):
    return 1 / (1 + math.exp(-(sum(weights.get(s, 0.0) * v for s, v in plain_features(text, bits).items()) + bias)))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c a b b b", "Ünï 12,345 %% x9x A_B don't", "é É 中文 word\x0bword " * 40])
def test_features_against_a_plain_loop(text):
    (_, slots, values), = quality.features(pa.array([text], pa.string()))
    want = plain_features(text, quality.BITS)
    assert dict(zip(slots.tolist(), values.tolist(), strict=True)) == pytest.approx(want, abs=1e-6)


@pytest.fixture(scope="module")
def model(spark):
    import random

    rows = corpus(random.Random(2), 900)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    train = labels.where(~quality.held_out())
    return docs, labels, quality.train(docs, train), rows


def test_held_out_accuracy(model):
    docs, labels, fitted, rows = model
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, fitted).collect()}
    test = [(y, got[i]) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(test) > 150 and sum((s >= 0.7) == bool(y) for y, s in test) / len(test) > 0.97
    assert {r["doc_id"] for r in labels.where(quality.held_out()).collect()} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}


def test_bytes_bound_the_training_rows(spark, model):
    """With few bytes only the first rows in order teach; the model is that of these rows alone."""
    docs, labels, fitted, rows = model
    train = labels.where(~quality.held_out())
    sizes = {i: 8 * len(plain_features(t, 18)) for i, t, _ in rows}
    order = train.selectExpr("doc_id", "xxhash64(doc_id, quality) as pick").orderBy("pick").collect()
    some, held = [], 0
    for r in order:
        held += sizes[r["doc_id"]]
        if held > 40_000:
            break
        some.append(r["doc_id"])
    few = quality.train(docs, train, max_bytes=40_000)
    alone = quality.train(docs, train.where(train.doc_id.isin(some)))
    assert 5 < len(some) < 400 and np.array_equal(few.weights, alone.weights) and not np.array_equal(few.weights, fitted.weights)


def test_same_model_again(model):
    docs, labels, fitted, _ = model
    again = quality.train(docs.repartition(7), labels.where(~quality.held_out()).repartition(3))
    assert np.array_equal(again.weights, fitted.weights) and again.bias == fitted.bias


def test_edges(spark, model, docs_of):
    _, _, fitted, _ = model
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "word " * 40_000), (4, "word " * 40_000), (5, "x")]
    out = quality.score(docs_of(rows), fitted)
    assert set(out.columns) == set(docs_of(rows).columns) and out.count() == len(rows)
    got = [(r["doc_id"], r["score"]) for r in out.collect()]
    bias = 1 / (1 + np.exp(-fitted.bias))
    assert all(0 <= s <= 1 for _, s in got) and all(abs(s - bias) < 1e-6 for i, s in got if i in (1, 2, 3))
    assert len({s for i, s in got if i == 4}) == 1
    none = quality.train(docs_of([]), spark.createDataFrame([], "doc_id long, quality int"))
    assert [r["score"] for r in quality.score(docs_of([(1, "a")]), none).collect()] == [0.5]
    assert quality.score(docs_of([]), fitted).count() == 0
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 5), (999, 1), (5, 1), (5, 1), (5, 0)], "doc_id long, quality int")
    assert quality.train(docs_of(rows), odd).weights.shape == fitted.weights.shape
