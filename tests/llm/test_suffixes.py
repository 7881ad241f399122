"""Repeated passages against brute force: in one process with small segments, and through Spark."""

import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from runlens.llm import suffixes


def slow(rows, length):
    first = {}
    for d, t in rows:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < d:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def in_process(rows, length, anchor, per_segment, buckets):
    """The steps of remove_repeats, each exchange played by a dictionary."""
    segs, hashes = {}, {}
    for k in range(0, len(rows), per_segment):
        own = rows[k : k + per_segment]
        ends = np.cumsum([len(t) for _, t in own], dtype=np.int64)
        segs[k] = suffixes.Segment(np.array([d for d, _ in own], np.int64).tobytes(), ends.tobytes(), suffixes._pack(b"".join(t for _, t in own)), length, anchor)
        hashes[k] = suffixes._Hashes(segs[k], buckets)
    sent = [(k, *r) for k, x in hashes.items() for r in x.runs(2)]
    bits, sample = {}, b""
    for _, g in pd.DataFrame(sent, columns=["segment", "bucket", "hashes", "several", "heavy", "sample"]).groupby("bucket"):
        for r in suffixes._answer_hashes(g, anchor).itertuples():
            if r.segment < 0:
                sample += r.bits
            else:
                bits[r.segment, r.bucket] = r.bits
    wanted = {k: x.wanted({b: v for (y, b), v in bits.items() if y == k}) for k, x in hashes.items()}
    splitters = np.frombuffer(suffixes.choose_splitters(sample, anchor, buckets), f"S{anchor}")
    assert len(splitters) < buckets
    runs = {k: suffixes.suffix_runs(s, *wanted[k], splitters, buckets) for k, s in segs.items()}
    blobs = [(k, b, b, suffixes.front_code(*r)) for k, (own, _) in runs.items() for b, r in own.items()]
    blobs += [(k, k % buckets, -1, notes) for k, (_, notes) in runs.items()]
    least = {}
    for _, g in pd.DataFrame(blobs, columns=["segment", "goes", "bucket", "run"]).groupby("goes"):
        least |= {(r.segment, r.bucket): r.least for r in suffixes._answer_runs(g, length, anchor).itertuples()}
    out = []
    for k, s in segs.items():
        answers = {b: v for (x, b), v in least.items() if x == k}
        covered = suffixes._covered(s.ids, s.ends, length, answers.pop(-1), answers)
        cut = suffixes._cut(s.ids, np.zeros(len(s.ids), bool), s.ends, s.data, covered, True)
        out += [tuple(r[:5]) + (r[7],) for r in cut.itertuples(index=False)]
    return out


def random_rows(rng, alphabet, n, most):
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(10, 90))) for _ in range(6)]
    rows = []
    for i in range(n):
        t = "".join(rng.choice(parts) if rng.random() < 0.5 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(most)))
        rows.append((i, t.encode()))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(60))
def test_steps_against_brute_force(seed, monkeypatch):
    if seed % 4 == 1:  # all anchors that occur twice or more count as frequent
        monkeypatch.setattr(suffixes, "HEAVY", 1)
        monkeypatch.setattr(suffixes, "HOT", 2)
    rng = random.Random(seed)
    alphabet = ["a", "ab", "abc ", "abcdefghij \n", "éaß"][seed % 5]
    rows = random_rows(rng, alphabet, rng.randrange(1, 25), 9)
    if seed % 3 == 0:  # ids that repeat are never each other's smaller document
        rows += [(d, t) for d, t in rows[:3]]
    length, anchor = [(50, 24), (20, 16), (33, 17)][seed % 3]
    got = in_process(rows, length, anchor, rng.randrange(1, 8), rng.randrange(1, 5))
    assert got == slow(rows, length)


def test_loser_tree_and_front_coding(rng):
    runs = []
    for _ in range(rng.randrange(1, 9)):
        keys = sorted({(("".join(rng.choice("ab") for _ in range(rng.randrange(1, 30)))).encode(), 0, 0) for _ in range(rng.randrange(0, 60))})
        keys = [(k, len(k), 0) for k, _, _ in keys]
        runs.append((keys, [rng.randrange(100) for _ in keys]))
    blobs = [suffixes.front_code(k, i) for k, i in runs]
    assert [[x[1:] for x in suffixes.decode_run(b)] for b in blobs] == [[(*k, i) for k, i in zip(ks, ids, strict=True)] for ks, ids in runs]
    out = list(suffixes.LoserTree([suffixes.decode_run(b) for b in blobs]))
    keys = [x[2][1] for x in out]
    assert keys == sorted(k for ks, _ in runs for k, _, _ in ks)
    for (_, shared, x), (_, _, before) in zip(out[1:], out, strict=False):
        assert shared == suffixes.common_prefix(before[1], x[1])
    assert list(suffixes.LoserTree([])) == [] and list(suffixes.LoserTree([iter([]), iter([])])) == []


def test_common_prefix():
    for a, b in ((b"", b""), (b"abc", b"abd"), (b"x" * 40, b"x" * 39), (b"x" * 20 + b"a", b"x" * 20 + b"b"), (b"\0" * 9, b"\0" * 8)):
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert all(suffixes.common_prefix(a, b, k) == n for k in range(n + 1))


def test_remove_repeats(docs_of, rng):
    rows = [(d, t.decode()) for d, t in random_rows(rng, "abcdefghij \n", 30, 12)]
    rows += [(100, None), (101, ""), (102, "short"), (103, "y" * 200_000), (104, "y" * 120), (105, rows[0][1]), (105, rows[0][1])]
    passage = "this passage of more than fifty bytes stands in several documents of the table"
    rows += [(200, "first " + passage + " end"), (201, passage), (202, "é" * 30 + passage)]
    got = sorted((tuple(r[:5]), bytes(r["kept"])) for r in suffixes.remove_repeats(docs_of(rows)).collect())
    want = sorted((x[:5], x[5]) for x in slow([(d, (t or "").encode()) for d, t in rows if d != 103], 50))
    assert [g for g in got if g[0][0] not in (103, 104)] == [w for w in want if w[0][0] != 104]
    by_id = {g[0][0]: g[0] for g in got}
    assert by_id[103][2] == 0 and by_id[104][2:4] == (120, 1) and by_id[201][2:4] == (len(passage), 1)


def test_one_anchor_in_very_many_contexts():
    """A line that all documents share, in different words each time: memory stays bounded and the work is dealt out."""
    line = b"(c) all rights reserved by someone" + b"."
    rng, n = random.Random(3), 30_000
    rows = [(i, bytes(rng.choices(b"abcdefgh ", k=40)) + line + bytes(rng.choices(b"abcdefgh ", k=40))) for i in range(n)]
    rows += [(n + 1, rows[7][1]), (n + 2, b"x" * 30 + rows[9][1][20:])]
    tracemalloc.start()
    got = in_process(rows, 50, 24, 5000, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {r[0]: r[2] for r in got if r[2]} == {n + 1: len(rows[7][1]), n + 2: len(rows[9][1]) - 20}
    sample = sorted(rng.sample(rows[:n], 300) + rows[n:] + [rows[7], rows[9]])
    sample = [r for k, r in enumerate(sample) if r not in sample[:k]]
    assert [r for r in in_process(sample, 50, 24, 50, 4)] == slow(sample, 50)
    assert peak < 400 << 20
    segs = suffixes.Segment(np.arange(5000).tobytes(), np.cumsum([len(t) for _, t in rows[:5000]], dtype=np.int64).tobytes(), suffixes._pack(b"".join(t for _, t in rows[:5000])), 50, 24)
    hot = np.ones(len(segs.at), bool)
    *_, where = suffixes._deal(segs, np.arange(len(segs.at)), hot, np.zeros(0, "S24"), 8)
    assert np.bincount(where, minlength=8).max() < 2 * len(where) / 8


def test_splitters():
    keys = [f"{i:024d}".encode() for i in range(100)]
    found = np.frombuffer(suffixes.choose_splitters(b"".join(keys), 24, 10), "S24")
    assert found.tolist() == keys[10::10]
    assert suffixes.choose_splitters(b"", 24, 10) == b"" and len(suffixes.choose_splitters(keys[0] * 50, 24, 10)) == 24


def test_null_ids_and_empty(docs_of):
    passage = "z" * 30 + "0123456789" * 4
    got = suffixes.remove_repeats(docs_of([(None, passage), (None, passage), (4, passage)]), texts=False).collect()
    assert sorted((r["doc_id"] is None, r["n_removed"]) for r in got) == [(False, 0), (True, len(passage)), (True, len(passage))]
    last = (1 << 63) - 1
    got = suffixes.remove_repeats(docs_of([(last, passage), (None, "short"), (3, "x" + passage)]), texts=False).collect()
    assert sorted((r["doc_id"] or 0, r["doc_id"] is None, r["n_removed"]) for r in got) == [(0, True, 0), (3, False, 0), (last, False, len(passage))]
    none = suffixes.remove_repeats(docs_of([]))
    assert none.count() == 0 and "kept" in none.columns
    r = suffixes.remove_repeats(docs_of([(1, passage + "a"), (2, "b" + passage)])).orderBy("doc_id").collect()[1]
    assert list(zip(r["starts"], r["stops"], strict=True)) == [(1, len(passage) + 1)] and bytes(r["kept"]) == b"b"
