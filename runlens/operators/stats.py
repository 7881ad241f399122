"""Correlations and a logistic model."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson's correlation as an aggregate; null where a side is constant or there are fewer than two pairs.

    Written with sums of centred-at-the-pair products, so that nothing divides by zero in ANSI mode; a pair counts if neither is null.
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.when((F.stddev_samp(x) > 0) & (F.stddev_samp(y) > 0), F.stddev_samp(x) * F.stddev_samp(y)))


def percentiles(rows: DataFrame, key: str, value: str, at: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """(key, percentiles): the exact percentiles ``at`` of each group's values, linear between two ranks, as an array.

    A first pass brackets each percentile by approximate ones, which are off by a share of 1 / ``accuracy`` of the group at most.  A second
    counts the values below each bracket and those within it, by value; only the latter, a few in ten thousand, are put in order.  Groups smaller than
    ``accuracy`` are their own bracket.  So no task holds a group's values.  Rows without a key or a value are left out.
    """
    kept = rows.select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")).where("k is not null and v is not null")
    margin = 2.0 / accuracy
    around = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in at for d in (-margin, margin)])
    bounds = kept.groupBy("k").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.percentile_approx("v", around, accuracy).alias("a"))
    few = F.col("n") < accuracy

    def wanted(i: int, p: float) -> Column:
        lo, hi = (F.when(few, F.col(end)).otherwise(F.col("a")[2 * i + j]) for j, end in enumerate(("low", "high")))
        return F.struct(F.lit(i).alias("i"), lo.alias("lo"), hi.alias("hi"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at"))

    parts = bounds.select("k", F.inline(F.array(*[wanted(i, p) for i, p in enumerate(at)])))
    inside = F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("x")  # null: below the bracket
    counts = kept.join(parts, "k").where("v <= hi").groupBy("k", "i", "at", inside).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("k", "i").orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.withColumn("b", before)
    holds = lambda rank: F.max(F.when((F.col("b") <= rank) & (rank < F.col("b") + F.col("n")), F.col("x")))
    both = ranked.groupBy("k", "i", "at").agg(holds(F.floor("at")).alias("l"), holds(F.ceil("at")).alias("u"))
    exact = F.struct("i", (F.col("l") + (F.col("u") - F.col("l")) * (F.col("at") - F.floor("at"))).alias("p"))
    found = both.groupBy("k").agg(F.array_sort(F.collect_list(exact)).alias("all"))  # as many as ``at``
    return found.select(F.col("k").alias(key), F.col("all.p").alias("percentiles"))


def _range(value: Column, edges: Sequence[float]) -> Column:
    """How many of the edges, which are in order, are below a value; looked up in two steps where there are many."""
    array = lambda xs: F.array(*[F.lit(float(x)) for x in xs]).cast("array<double>")
    below = lambda xs: F.size(F.filter(xs, lambda c: c < value))
    if len(edges) <= 128:
        return below(array(edges))
    step = math.isqrt(len(edges)) + 1
    base = F.greatest(below(array(edges[::step])) - 1, F.lit(0)) * step
    return base + below(F.slice(array(edges), base + 1, F.lit(step)))


def rank_tables(rows: DataFrame, columns: Sequence[str], range_rows: int = 1_000_000, least: int = 64, most: int = 4096) -> list[DataFrame]:
    """For each column a table (value, rank): the rank of each of its values, equal values sharing the mean of their ranks.

    Values are counted once each, dealt into ranges by approximate quantiles and numbered inside a range, so neither a frequent value nor
    the table's size makes one large task: there is a range for every ``range_rows`` rows.  Missing values have no rank.
    """
    buckets = max(least, min(most, rows.count() // range_rows))
    quantiles = rows.approxQuantile(list(columns), [i / buckets for i in range(1, buckets)], 0.64 / buckets)
    out = []
    for column, cuts in zip(columns, quantiles, strict=True):
        counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("_n"))
        counts = counts.withColumn("_b", _range(F.col("value"), sorted(set(cuts))))
        totals = counts.groupBy("_b").agg(F.sum("_n").alias("_t"))
        order = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.select("_b", F.coalesce(F.sum("_t").over(order), F.lit(0)).alias("_s"))  # a row for each range
        inside = Window.partitionBy("_b").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(starts), "_b")
        out.append(ranked.select("value", (F.col("_s") + F.col("_before") + (F.col("_n") + 1) / 2.0).alias("rank")))
    return out


def _rank_corr(rows: DataFrame, a: str, b: str, ranks_a: DataFrame, ranks_b: DataFrame) -> DataFrame:
    left = rows.select(F.col(a).alias("a"), F.col(b).alias("b")).join(ranks_a.select(F.col("value").alias("a"), F.col("rank").alias("ra")), "a")
    both = left.join(ranks_b.select(F.col("value").alias("b"), F.col("rank").alias("rb")), "b")
    return both.agg(safe_corr(F.col("ra"), F.col("rb")).alias("value"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row with Spearman's correlation in the column value, over the rows where both are there."""
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return _rank_corr(rows, a, b, *rank_tables(rows, [a, b]))


def correlations(merged: DataFrame) -> DataFrame:
    """(metric, value): Pearson and Spearman of epoch and quality, and of quality and error; rows without any of these are left out."""
    columns = ["epoch", "mean_plddt", "relax_error"]
    rows = merged.dropna(subset=columns)
    ranks = dict(zip(columns, rank_tables(rows, columns), strict=True))
    pairs = (("epoch", "mean_plddt"), ("mean_plddt", "relax_error"))
    names = [f"pearson_{a}_{b}" for a, b in pairs]
    pearson = rows.agg(*[safe_corr(F.col(a), F.col(b)).alias(n) for n, (a, b) in zip(names, pairs, strict=True)])
    out = pearson.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))
    for a, b in pairs:
        out = out.union(_rank_corr(rows, a, b, ranks[a], ranks[b]).select(F.lit(f"spearman_{a}_{b}").alias("metric"), "value"))
    return out


@dataclass
class Fit:
    """A model's coefficients, whether it was fitted, and why not."""

    coefficients: DataFrame
    fitted: bool
    report: str


def logistic(merged: DataFrame, max_iter: int = 50, most: float = 30.0) -> Fit:
    """Logistic regression of the error flag on quality, epoch, chain and repeat (the latter two as factors).

    The first level of each factor is its reference.  Separated data don't raise in Spark but give huge coefficients, so a fit that used
    all iterations, a flag of one class, or a coefficient beyond ``most`` standard units counts as failed: the table is then empty.
    """
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from pyspark.ml.feature import RFormula
    from pyspark.ml.regression import GeneralizedLinearRegression

    spark = merged.sparkSession
    empty = spark.createDataFrame([], "term string, coef double, pvalue double")
    rows = merged.where("mean_plddt is not null and relax_error is not null and epoch is not null and chain is not null and repeat is not null")
    rows = rows.select(F.col("relax_error").cast("double").alias("label_"), F.col("mean_plddt").cast("double").alias("mean_plddt"), F.col("epoch").cast("double").alias("epoch"), F.col("chain").cast("string").alias("chain"), F.col("repeat").cast("string").alias("repeat"))
    seen = rows.agg(F.count_distinct("label_").alias("labels"), F.stddev_samp("mean_plddt").alias("sd"), F.stddev_samp("epoch").alias("se"), F.count_distinct("chain").alias("c"), F.count_distinct("repeat").alias("r")).first()
    if seen["labels"] < 2:
        return Fit(empty, False, "the flag has one class")
    used = [n for n, ok in (("mean_plddt", seen["sd"]), ("epoch", seen["se"]), ("chain", seen["c"] > 1), ("repeat", seen["r"] > 1)) if ok]
    if not used:
        return Fit(empty, False, "no term varies")
    try:
        formula = RFormula(formula=f"label_ ~ {' + '.join(used)}", stringIndexerOrderType="alphabetDesc", featuresCol="features", labelCol="y")
        data = formula.fit(rows).transform(rows)
        model = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="features", labelCol="y", maxIter=max_iter, tol=1e-10).fit(data)
        summary = model.summary
        iterations, pvalues = summary.numIterations, list(summary.pValues)
    except (PySparkException, Py4JJavaError) as e:  # what Spark's solver raises; the tables made so far stand
        return Fit(empty, False, f"the solver failed: {str(e).splitlines()[0]}")
    attrs = data.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    scale = {"mean_plddt": seen["sd"], "epoch": seen["se"]}
    out = [("Intercept", float(model.intercept), float(pvalues[-1]))]
    for i, coef in enumerate(model.coefficients):
        name, _, level = names[i].partition("_") if names[i] not in scale else (names[i], "", "")
        out.append((f"C({name})[T.{level}]" if level else name, float(coef), float(pvalues[i])))
        if abs(coef) * (scale.get(names[i]) or 1.0) > most:
            return Fit(empty, False, f"the data are separated at {names[i]}")
    if iterations >= max_iter:
        return Fit(empty, False, "the solver did not converge")
    return Fit(spark.createDataFrame(out, "term string, coef double, pvalue double"), True, f"{iterations} iterations, deviance {summary.deviance:.6f}, null deviance {summary.nullDeviance:.6f}")
