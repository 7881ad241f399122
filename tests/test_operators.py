"""Edge cases of joins, selections, statistics and plans."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens import functions as fn
from runlens.operators import outcome, planning, quality, selection, stats

OUT = "epoch int, repeat int, chain string, relax_success int, relax_error int"


def test_validated_join(spark):
    left = spark.createDataFrame([(1, 1, "A", 1, 0), (1, 2, None, 0, 1)], OUT)
    q = [(1, 1, "A", 80.0, "unrelaxed"), (1, 1, "A", 81.0, "relaxed"), (1, 2, None, 70.0, "unrelaxed")]
    right = spark.createDataFrame(q, "epoch int, repeat int, chain string, mean_plddt double, state string")
    rows = quality.merge(left, right).orderBy("repeat").collect()
    assert [r["mean_plddt"] for r in rows] == [80.0, 70.0]
    with pytest.raises(quality.DuplicateKeyError, match="'chain': 'A'"):
        quality.join_validated(left, right)


def test_columns(spark):
    df = spark.createDataFrame([(1, float("nan"), "x")], "a int, b double, c string")
    assert fn.nan_to_null(df).first()["b"] is None
    with pytest.raises(ValueError, match=r"\['y', 'z'\]"):
        fn.require_columns(df, ["z", "a", "y"])
    assert fn.project_keep(df, ["c", "q", "a"]).columns == ["c", "a"]
    assert df.select(fn.default_column(df, "q"), fn.strip(F.lit("\t x \n")).alias("s")).first() == ("", "x")
    assert fn.where_if_present(df, "nope", 1).count() == 1
    assert df.select(fn.ratio(F.lit(1), F.lit(0)).alias("r")).first()["r"] is None


def test_argmax_and_recommendations(spark):
    rows = [(1, 1, "A", 1, 0), (1, 2, "A", 1, 0), (1, 3, "A", 0, 1), (2, 1, "A", 1, 0), (3, 1, "A", 1, 0), (4, 1, "A", 1, 0), (1, 1, "B", 1, 0)]
    q = [(e, r, c, 80.0) for e, r, c, *_ in rows] + [(1, 2, "A", 80.0)]
    best, some = selection.recommend(spark.createDataFrame(rows, OUT), spark.createDataFrame(q, "epoch int, repeat int, chain string, mean_plddt double"))
    assert [tuple(r)[:3] for r in best.collect()] == [("A", 1, 1), ("A", 2, 1), ("A", 3, 1), ("A", 4, 1), ("B", 1, 1)]
    assert [tuple(r)[:2] for r in some.collect()] == [("A", 1), ("A", 3), ("A", 4), ("B", 1)]
    assert "relaxed_path" in best.columns


@pytest.mark.parametrize("n,wanted", [(1, [1]), (2, [1, 2]), (3, [1, 2, 3]), (4, [1, 3, 4]), (7, [1, 4, 7])])
def test_first_mid_last(spark, n, wanted):
    df = spark.range(1, n + 1).select(F.lit("A").alias("chain"), F.col("id").alias("epoch"))
    assert sorted(r["epoch"] for r in selection.first_mid_last(df, ["chain"], ["epoch"]).collect()) == wanted


def test_counts_pivot_and_empty(spark):
    rows = [(1, r, "A", 1, 0) for r in range(1, 7)] + [(2, 1, "B", 1, 0)]
    c = selection.epoch_chain_counts(spark.createDataFrame(rows, OUT))
    assert {(r["chain"], r["all5_success"], r["atleast4_success"]) for r in c.collect()} == {("A", 0, 1), ("B", 0, 0)}
    assert {tuple(r) for r in selection.pivot(c, "success").collect()} == {("A", 6, None), ("B", None, 1)}
    empty = spark.createDataFrame([], OUT)
    none = selection.epoch_chain_counts(empty)
    assert none.count() == selection.chain_priority(none).count() == selection.first_full(none).count() == 0
    assert outcome.summarize(empty, "epoch").count() == 0


def test_summaries(spark):
    rows = [(1, 1, "A", 1, 0, None), (1, 2, "A", 0, 1, None), (2, 1, "A", 1, 0, 5.0), (None, 1, "A", 1, 0, 5.0)]
    s = {r["epoch"]: r for r in quality.summarize(spark.createDataFrame(rows, OUT + ", mean_plddt double"), "epoch").collect()}
    assert set(s) == {1, 2} and s[1]["total"] == 2 and s[1]["mean_plddt"] is None and s[2]["std_plddt"] is None


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_percentiles(spark, accuracy):
    """Against sorted lists; with a low accuracy the brackets are narrow and rows below them are only counted."""
    rng, rows = random.Random(6), []
    for n in (1, 2, 3, 49, 50, 51, 700, 3000):
        rows += [(f"g{n}", rng.choice([rng.gauss(0, 1), float(rng.randrange(4))])) for _ in range(n)]
    rows += [("same", 2.0)] * 400 + [("none", None), (None, 1.0)]
    at = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["g"]: r["percentiles"] for r in stats.percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", at, accuracy).collect()}
    assert set(got) == {g for g, v in rows if g and v is not None}
    for g, found in got.items():
        own = sorted(v for h, v in rows if h == g and v is not None)
        for p, x in zip(at, found, strict=True):
            k = p * (len(own) - 1)
            lo, hi = own[math.floor(k)], own[math.ceil(k)]
            assert x == pytest.approx(lo + (hi - lo) * (k - math.floor(k)), abs=1e-12), (g, p)
    assert stats.percentiles(spark.createDataFrame([], "g string, v double"), "g", "v", at).count() == 0


def test_many_ranges(spark):
    rng = random.Random(7)
    values = [float(rng.randrange(900)) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    table = stats.rank_tables(df, ["v"], range_rows=10)[0]
    got = {r["value"]: r["rank"] for r in table.collect()}
    order = sorted(values)
    assert got == {v: order.index(v) + (values.count(v) + 1) / 2 for v in set(values)}


def test_pivot_raises_on_duplicates(spark):
    df = spark.createDataFrame([("A", 1, 2), ("A", 1, 3), ("B", 1, 1)], "chain string, epoch int, success int")
    with pytest.raises(Exception, match="duplicate cell: chain A, epoch 1"):
        selection.pivot(df, "success", [1, 2]).collect()


def newton(x, y):
    """Coefficients and two-sided p-values of a logistic regression, by plain Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        info = x.T @ (x * (p * (1 - p))[:, None])
        step = np.linalg.solve(info, x.T @ (y - p))
        beta += step
        if np.abs(step).max() < 1e-12:
            break
    z = beta / np.sqrt(np.diag(np.linalg.inv(info)))
    return beta, [math.erfc(abs(v) / math.sqrt(2)) for v in z]


def test_logistic_against_newton(spark):
    rng = np.random.default_rng(3)
    n = 1200
    q, e, c, r = rng.uniform(0, 4, n), rng.integers(0, 6, n), rng.integers(0, 3, n), rng.integers(1, 4, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.7 - q + 0.2 * e + (c == 1) - 0.5 * (r == 2))))).astype(float)
    rows = [(int(e[i]), int(r[i]), "ABC"[c[i]], int(y[i]), float(q[i])) for i in range(n)]
    fit = stats.logistic(spark.createDataFrame(rows, "epoch int, repeat int, chain string, relax_error int, mean_plddt double"))
    x = np.stack([np.ones(n), q, e, c == 1, c == 2, r == 2, r == 3], axis=1).astype(float)
    beta, pvalues = newton(x, y)
    terms = ["Intercept", "mean_plddt", "epoch", "C(chain)[T.B]", "C(chain)[T.C]", "C(repeat)[T.2]", "C(repeat)[T.3]"]
    got = {t["term"]: (t["coef"], t["pvalue"]) for t in fit.coefficients.collect()}
    assert set(got) == set(terms)
    for term, b, p in zip(terms, beta, pvalues, strict=True):
        assert got[term] == (pytest.approx(b, abs=1e-6), pytest.approx(p, abs=1e-6)), term


def test_a_bug_is_not_a_failed_fit(spark, monkeypatch):
    import pyspark.ml.regression as ml

    def broken(*a, **k):
        raise TypeError("a bug")

    monkeypatch.setattr(ml, "GeneralizedLinearRegression", broken)
    df = spark.createDataFrame([(e, 1, "A", e % 2, float(e)) for e in range(9)], "epoch int, repeat int, chain string, relax_error int, mean_plddt double")
    with pytest.raises(TypeError, match="a bug"):
        stats.logistic(df)


def test_merge_keeps_the_order_of_columns(spark):
    left = spark.createDataFrame([(1, 1, "A", "x", 1, 0)], "epoch int, repeat int, chain string, status string, relax_success int, relax_error int")
    right = spark.createDataFrame([(1, 1, "A", 80.0)], "epoch int, repeat int, chain string, mean_plddt double")
    assert quality.merge(left, right).columns == ["epoch", "repeat", "chain", "status", "relax_success", "relax_error", "mean_plddt"]


def test_chains(spark):
    rows = [(0, "1ABC", "a", 1, 10), (1, "1abc", "A", 1, 11), (2, "2xyz", "B", 2, 12)]
    df = spark.createDataFrame(rows, "pos int, pdb_id string, chain_id string, model_id int, chain_length int")
    got = selection.prepare_chains(df, [F.col("pos")]).collect()
    assert [(r["chain_key"], r["chain_length"]) for r in got] == [("1abc_A", 10)]


def test_correlations(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(1, 5), float(rng.randrange(20)) if rng.random() > 0.1 else None, rng.randrange(2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "epoch int, mean_plddt double, relax_error int")
    got = {r["metric"]: r["value"] for r in stats.correlations(df).collect()}
    kept = [r for r in rows if r[1] is not None]

    def rank(xs):
        return [sum(y < x for y in xs) + (sum(y == x for y in xs) + 1) / 2 for x in xs]

    def corr(a, b):
        ma, mb = sum(a) / len(a), sum(b) / len(b)
        return sum((x - ma) * (y - mb) for x, y in zip(a, b)) / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))

    e, q, f = zip(*kept)
    assert got["pearson_epoch_mean_plddt"] == pytest.approx(corr(e, q), abs=1e-9)
    assert got["spearman_epoch_mean_plddt"] == pytest.approx(corr(rank(e), rank(q)), abs=1e-9)
    assert got["spearman_mean_plddt_relax_error"] == pytest.approx(corr(rank(q), rank(f)), abs=1e-9)
    constant = stats.correlations(df.withColumn("relax_error", F.lit(0)))
    assert {r["metric"]: r["value"] for r in constant.collect()}["pearson_mean_plddt_relax_error"] is None


def test_logistic(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(1500):
        q, c, e = rng.uniform(0, 4), rng.choice("AB"), rng.randrange(5)
        p = 1 / (1 + math.exp(-(1.0 - q + (c == "B"))))
        rows.append((e, rng.randrange(1, 4), c, int(rng.random() < p), q))
    df = spark.createDataFrame(rows, "epoch int, repeat int, chain string, relax_error int, mean_plddt double")
    fit = stats.logistic(df)
    assert fit.fitted
    coef = {r["term"]: (r["coef"], r["pvalue"]) for r in fit.coefficients.collect()}
    assert set(coef) == {"Intercept", "mean_plddt", "epoch", "C(chain)[T.B]", "C(repeat)[T.2]", "C(repeat)[T.3]"}
    assert coef["mean_plddt"][0] == pytest.approx(-1, abs=0.2) and coef["C(chain)[T.B]"][0] == pytest.approx(1, abs=0.4) and coef["mean_plddt"][1] < 1e-6
    for bad in (df.withColumn("relax_error", F.lit(0)), df.withColumn("relax_error", (F.col("mean_plddt") > 2).cast("int")), df.withColumn("relax_error", F.when(F.col("chain") == "A", 1).otherwise(F.col("relax_error"))), df.limit(0)):
        failed = stats.logistic(bad)
        assert not failed.fitted and failed.report and failed.coefficients.count() == 0 and failed.coefficients.columns == ["term", "coef", "pvalue"]


def test_plans(spark):
    plan = planning.preset(spark, "v6")
    assert plan.count() == 30 and {r["block"] for r in plan.collect()} == {"ep21"}
    three = planning.run_plan(spark, [32], 5, models=["a", "b", "c"], samples=5)
    assert three.count() == 75 and three.agg(F.min("seed"), F.max("seed"), F.max("step")).first() == (1001, 1005, 330000)
    listing = spark.createDataFrame([("/p/ep10/10000.ckpt",), ("/o/32.ckpt",), ("/z/ep33/330000.ckpt",)], "path string")
    got = planning.choose_checkpoint(planning.run_plan(spark, [0, 5, 32], 1), listing, "/p/{block}/{step}.ckpt", "/z/{block}/{step}.ckpt", {32: "/o/32.ckpt"})
    assert {(r["epoch"], r["checkpoint"]) for r in got.collect()} == {(0, "/p/ep10/10000.ckpt"), (32, "/o/32.ckpt")}


def test_work_list(spark):
    un, re = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("b",), ("b",)], "k string")
    assert outcome.pending(un, re, ["k"]).collect()[0][0] == "a" and outcome.done(un, re, ["k"]).count() == 1


def test_correlations_of_nothing(spark):
    empty = spark.createDataFrame([], "epoch int, mean_plddt double, relax_error int")
    assert {r["value"] for r in stats.correlations(empty).collect()} == {None}
    assert stats.spearman(empty, "epoch", "mean_plddt").collect()[0]["value"] is None
