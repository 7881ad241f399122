"""Every stage of the pipeline on awkward tables."""

import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from runlens.llm import decontam, licenses, mixing, neighbours, quality, sharding, simhash, suffixes, urls

NAMES = "_score score fp0 node least component_id item_id found row size class part key digest copies copy target h pick Slot Host Licence a.b Doc_Id2 text_".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("tables")
    labels = [(i, int(i % 3 > 0), 0) for i in range(40)] + [(None, 1, 0), (3, None, None), (999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    items = [(1, "a benchmark item of quite a few words here"), (2, None), (3, ""), (None, "x"), (1, "a benchmark item of quite a few words here")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return str(top)


def table(spark, rows):
    extra = ", ".join(f"`{n}` string" for n in NAMES)
    full = [(i, t, "en", s, len(t or ""), *["mine"] * len(NAMES)) for i, t, s in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


ROWS = [(i, ("good words of many kinds " + " ".join(f"w{i * 7 + k}" for k in range(30))) if i % 3 else "bad bad bad bad " * 9, f"s{i % 2}") for i in range(40)]
ROWS += [(50, None, "s0"), (51, "", None), (52, " \n", "s1"), (53, "long " * 60_000, "s1"), (None, "no id but words", "s0"), (None, None, None), (7, ROWS[7][1], "s1"), (7, ROWS[7][1], "s1")]
ROWS += [(60, "before it A Benchmark item of quite a few words here and after it", "s0"), (61, ROWS[8][1], None), (62, ROWS[8][1].upper(), "ü")]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, folder, name, stage):
    docs = table(spark, ROWS)
    out = stage(spark, docs, folder)
    rows = out.collect()
    last = name == corpus_pipeline.STAGES[-1][0]
    kept = [i for i, c in enumerate(docs.columns) if not last or c.lower() not in ("slot", "shard")]
    assert out.columns == [docs.columns[i] for i in kept] + (["slot", "shard"] if last else [])
    given = {tuple(r[i] for i in kept) for r in docs.collect()}
    assert all(tuple(r)[: len(kept)] in given for r in rows)
    none = stage(spark, docs.limit(0), folder)
    assert none.count() == 0 and none.columns == out.columns
    ids = [r["doc_id"] for r in rows]
    if name == "SimHash near-dedup":
        assert ids.count(7) == 1 and 61 not in ids and 62 not in ids and ids.count(None) == 2 and sum(i in (50, 51, 52) for i in ids) <= 1
    if name == "benchmark decontamination":
        assert len(rows) == len(ROWS) - 1 and 60 not in ids
    if name == "sharding":
        assert len(rows) == len(ROWS)


def test_run(spark, folder, tmp_path):
    for f in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{f}.parquet").write.parquet(f"{tmp_path}/{f}.parquet")
    table(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not ids & {60, 61, 62} and quality.THRESHOLD == 0.7


def test_all_operators_with_awkward_names(spark, folder):
    """Names with dots, and names that differ in case from a new column's or from one another."""
    own = spark.createDataFrame([(i, f"some words of text {i}", "s", "http://a.net/fr/", f"d/{i}", "x") for i in range(30)]).toDF("Doc_ID", "text", "source", "url", "a.path", "TEXT")
    frames = {
        "slot": sharding.assign(own),
        "copies": mixing.sample(own),
        "mix": mixing.mix(own),
        "score": quality.score(own, quality.train(own, spark.read.parquet(f"{folder}/labels.parquet"))),
        "one": simhash.keep_one_of_each(own),
        "groups": simhash.near_duplicates(own),
        "clean": decontam.decontaminate(own, spark.read.parquet(f"{folder}/benchmark.parquet")),
        "pairs": decontam.contained(own, spark.read.parquet(f"{folder}/benchmark.parquet")),
        "verdict": urls.judge(own.toDF("Host", "Rule", "source", "url", "a.b", "VERDICT")),
        "licence": licenses.scan(own.toDF("Licence", "text", "source", "url", "a.path", "TEXT"), path_col="a.path"),
        "cut": suffixes.remove_repeats(own),
        "near": neighbours.nearest(own.select(*[F.col(f"`{c}`") for c in own.columns[:1]], F.array(F.lit(1.0), F.rand(1)).alias("a.v"), F.lit(1).alias("ID")), F.col("Doc_ID") % 20 == 0, id_col="doc_id", vector_col="a.v"),
    }
    found = {k: (len(v.collect()), v.columns) for k, v in frames.items()}
    assert found["slot"] == (30, [*own.columns, "slot", "shard"]) and found["mix"][1] == own.columns
    assert found["score"] == (30, [*own.columns, "score"]) and found["one"][1] == found["clean"][1] == own.columns
    assert found["verdict"] == (30, ["source", "url", "a.b", "host", "path", "rule", "verdict"])
    assert found["licence"] == (30, ["source", "url", "a.path", "TEXT", "licence", "licence_score", "licence_line", "licence_from"])
    assert found["copies"][0] == found["groups"][0] == found["cut"][0] == 30 and found["near"][0] == 40 and found["pairs"][0] == 0


def test_rejected_documents_go(spark, folder):
    kept = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, table(spark, ROWS), folder).collect()}
    assert not kept & {0, 3, 6, 9} and {1, 2, 4, 5} <= kept
