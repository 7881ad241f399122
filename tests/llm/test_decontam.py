"""Containment against brute force, both ways."""

import random

import pytest

from runlens.llm import decontam


def sh(text, n=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not w:
        return set()
    m = min(n, len(w))
    return {" ".join(w[i : i + m]) for i in range(len(w) - m + 1)}, m


def brute(docs, items):
    out = set()
    for d, text in docs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        for i, item in items:
            own = sh(item)
            if not own:
                continue
            own, m = own
            have = {" ".join(w[k : k + m]) for k in range(len(w) - m + 1)}
            if len(own & have) >= 0.8 * len(own) - 1e-9:
                out.add((d, i, len(own), len(own & have)))
    return out


def cases(rng):
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 4, 5, 6, 9, 14, 30, 55]))) for i in range(25)] + [(90, None), (91, ""), (92, "Same Text Here twice now"), (93, "same text here twice now")]
    docs = []
    for d in range(40):
        parts = [text(rng.randrange(80))]
        for _, item in rng.sample(items, 3):
            w = (item or "").split()
            if w and rng.random() < 0.6:  # some words changed: around the threshold
                for _ in range(rng.randrange(3)):
                    w[rng.randrange(len(w))] = "changed"
            parts += [" ".join(w).upper() if rng.random() < 0.2 else "\n".join(w), text(rng.randrange(60))]
        docs.append((d, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, text(30_000) + " " + items[8][1] + " " + text(20_000)), (103, "same text here twice now")]
    return docs, items


@pytest.mark.parametrize("small", [True, False])
def test_pairs(spark, docs_of, monkeypatch, small):
    rng = random.Random(6)
    docs, items = cases(rng)
    if not small:
        monkeypatch.setattr(decontam, "MOST_MINIMA", 3)
    table = spark.createDataFrame([(*i, 1) for i in items] + [(None, "no id here at all", 1)], "item_id long, text string, row int")
    found = decontam.contained(docs_of(docs), table)
    got = [tuple(r) for r in found.select("doc_id", "item_id", "shingles", "found").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items)
    assert any(f < s for _, _, s, f in got) and (102, 8) in {g[:2] for g in got}
    clean = decontam.decontaminate(docs_of(docs), table)
    assert clean.columns == docs_of(docs).columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, *_ in got}


def test_minima():
    for q in range(1, 200):
        need = -(-8 * q // 10)
        assert decontam.minima(q) == q - need + 1


def test_empty_and_repeats(spark, docs_of):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    none = items.limit(0)
    docs = docs_of([(7, "x one two three four five six y"), (7, "x one two three four five six y"), (None, "one two three four five six")])
    assert sorted((r["doc_id"] or -1, r["item_id"]) for r in decontam.contained(docs, items).collect()) == [(-1, 1), (7, 1), (7, 1)]
    assert decontam.contained(docs, none).count() == 0 and decontam.decontaminate(docs, none).count() == 3
    assert decontam.contained(docs_of([]), items).count() == 0 and decontam.decontaminate(docs, items).count() == 0
