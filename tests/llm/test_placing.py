"""Sharding and mixing."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from runlens.llm import mixing, sharding


def slow_table(shards, size):
    """Whole preference lists, turn by turn."""
    d = lambda s, salt: int(hashlib.md5(f"{salt}:{s}".encode()).hexdigest()[:15], 16)
    prefs = [[(d(s, "offset") + j * (d(s, "skip") % (size - 1) + 1)) % size for j in range(size)] for s in shards]
    table, turn = {}, 0
    while len(table) < size:
        i = turn % len(shards)
        table[next(p for p in prefs[i] if p not in table)] = i
        turn += 1
    return [table[k] for k in range(size)]


@pytest.mark.parametrize("n,size", [(1, 2), (3, 13), (7, 101), (13, 13)])
def test_table(n, size):
    shards = tuple(f"s{i}" for i in range(n))
    table = sharding.lookup_table(shards, size)
    assert table == slow_table(shards, size)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == n


def test_little_moves():
    before, after = sharding.lookup_table(), sharding.lookup_table(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != len(sharding.SHARDS) - 1)
    assert moved / len(before) < 0.15
    for bad in (("a", "a"), ()):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 13)
    with pytest.raises(ValueError):
        sharding.lookup_table(("a",), 15)


def test_assign(docs_of):
    rows = [(i, "t") for i in range(500)] + [(3, "again"), (None, None)]
    out = sharding.assign(docs_of(rows))
    table = sharding.lookup_table()
    for r in out.collect():
        slot = int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16) % sharding.SIZE
        assert (r["slot"], r["shard"]) == (slot, table[slot])
    assert out.count() == len(rows) and sharding.assign(docs_of([])).count() == 0
    again = sharding.assign(out)
    assert again.columns == out.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "hashpartitioning" not in plan


def fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share out, cap, and share the excess again until none is above."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = [s for s in open_ if unit * w[s] > most * sizes[s]]
        if not over:
            target |= {s: unit * w[s] for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000, 20000]) for i in range(rng.randrange(1, 9))} | ({None: 40} if seed % 2 else {})
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(fill(sizes))


def rows_of(rng, n):
    rows = []
    for i in range(n):
        source = rng.choice(["src0"] * 6 + ["src1", "src2", "ü", "Z", None, ""])
        size = int(rng.lognormvariate(4, 1)) if rng.random() > 0.05 else 0
        rows.append((i, " ".join(["w"] * size) if rng.random() > 0.02 else None, source))
    return rows


def test_mix(spark):
    rng = random.Random(12)
    rows = rows_of(rng, 3000) + [(5000 + i, "copy of one text", "src0") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1)).withColumn("class", F.lit("x"))
    out = mixing.sample(docs).collect()
    assert len(out) == len(rows)
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    total, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, _, s in rows:
        total[s] += sizes[i]
        biggest[s] = max(biggest[s], sizes[i])
    want = fill(total)
    for r in out:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2 and r["copies"] in (math.floor(want[r["source"]] / total[r["source"]]), math.ceil(want[r["source"]] / total[r["source"]]))
        taken[r["source"]] += r["copies"] * r["size"]
    for s in total:
        assert abs(taken[s] - want[s]) <= 2 * biggest[s] + 0.02 * want[s]
    again = {r["doc_id"]: r["copies"] for r in mixing.sample(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in out}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: c for i, c in again.items() if c})


def test_mix_edges(spark, docs_of):
    assert mixing.sample(docs_of([])).count() == 0 == mixing.mix(docs_of([])).count()
    rows = docs_of([(1, None), (2, ""), (None, " ")])
    assert [(r["size"], r["target"], r["copies"]) for r in mixing.sample(rows).collect()] == [(0, 0.0, 0)] * 3
    twice = docs_of([(1, "a b"), (1, "a b"), (2, "long " * 50_000)])
    got = mixing.sample(twice).collect()
    assert len(got) == 3 and sum(r["copies"] for r in got) in (4, 5)
