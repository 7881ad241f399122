"""Quality tables: joins to outcomes and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import project_keep, ratio, where_if_present
from .stats import percentiles

KEYS = ["epoch", "repeat", "chain"]
#: The columns of the two tables, in their order.
OUTCOME_COLUMNS = [*KEYS, "status", "relax_success", "relax_error", "unrelaxed_path", "relaxed_path", "relaxed_exists"]
QUALITY_COLUMNS = [*KEYS, "mean_plddt", "min_plddt", "max_plddt", "num_residues", "state", "pdb_path"]


class DuplicateKeyError(ValueError):
    """A side of a one-to-one join has a key twice."""


def check_unique(df: DataFrame, keys: list[str], side: str) -> None:
    """Raise if a key occurs twice; the message names one of them."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(1).first()
    if twice is not None:
        raise DuplicateKeyError(f"{side}: {twice.asDict()}")


def join_validated(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A left join that is one-to-one, or an error.  Null keys meet null keys."""
    keys = keys or KEYS
    check_unique(left, keys, "left side")
    check_unique(right, keys, "right side")
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    fits = F.lit(True)
    for k in keys:
        fits = fits & left[k].eqNullSafe(other[f"_{k}"])
    return left.join(other, fits, "left").drop(*[f"_{k}" for k in keys])


def merge(outcomes: DataFrame, quality: DataFrame) -> DataFrame:
    """Outcomes with the quality of their unrelaxed files."""
    left = project_keep(outcomes, OUTCOME_COLUMNS)
    right = project_keep(where_if_present(quality, "state", "unrelaxed"), QUALITY_COLUMNS)
    return join_validated(left, right)


def summarize(merged: DataFrame, key: str) -> DataFrame:
    """Outcome counts and rates with mean, exact median, deviation and range of the quality, by one column."""
    m = F.col("mean_plddt")
    out = (
        merged.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("*").alias("total"),
            F.coalesce(F.sum("relax_error"), F.lit(0)).cast("bigint").alias("errors"),
            F.coalesce(F.sum("relax_success"), F.lit(0)).cast("bigint").alias("success"),
            F.avg(m).alias("mean_plddt"),
            F.stddev_samp(m).alias("std_plddt"),
            F.min(m).alias("min_plddt"),
            F.max(m).alias("max_plddt"),
        )
    )
    out = _with_median(out, merged, key, "median_plddt")
    out = out.select(key, "total", "errors", "success", "mean_plddt", "median_plddt", "std_plddt", "min_plddt", "max_plddt")
    return out.withColumn("error_rate", ratio(F.col("errors"), F.col("total"))).withColumn("success_rate", ratio(F.col("success"), F.col("total")))


def by_outcome(merged: DataFrame) -> DataFrame:
    """The distribution of the quality for each outcome."""
    m = F.col("mean_plddt")
    out = (
        merged.where(F.col("relax_error").isNotNull())
        .groupBy("relax_error")
        .agg(
            F.count(m).alias("count"),
            F.avg(m).alias("mean"),
            F.stddev_samp(m).alias("std"),
            F.min(m).alias("min"),
            F.max(m).alias("max"),
        )
    )
    return _with_median(out, merged, "relax_error", "median").select("relax_error", "count", "mean", "median", "std", "min", "max")


def _with_median(summary: DataFrame, merged: DataFrame, key: str, name: str) -> DataFrame:
    """A summary by one column with the exact median of the quality; null where a group has none."""
    found = percentiles(merged, key, "mean_plddt", [0.5])
    return summary.join(found, key, "left").withColumn(name, F.col("percentiles")[0])


def box_inputs(merged: DataFrame) -> DataFrame:
    """The five numbers of a box chart for each outcome, exact."""
    out = percentiles(merged, "relax_error", "mean_plddt", [0.0, 0.25, 0.5, 0.75, 1.0])
    return out.select("relax_error", *[F.col("percentiles")[i].alias(n) for i, n in enumerate(("low", "q1", "median", "q3", "high"))])


def mean_quality(merged: DataFrame, key: str) -> DataFrame:
    """(key, mean_plddt) in order of the key."""
    return merged.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg("mean_plddt").alias("mean_plddt")).orderBy(key)


def scatter_inputs(merged: DataFrame, seed: int = 42, spread: float = 0.03) -> DataFrame:
    """(mean_plddt, relax_error, jittered): chart points with seeded noise on the flag."""
    rows = merged.where("mean_plddt is not null")
    return rows.select("mean_plddt", "relax_error", (F.col("relax_error") + F.randn(seed) * spread).alias("jittered"))
