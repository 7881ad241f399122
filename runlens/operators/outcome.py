"""Outcome summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio


def _rates(summary: DataFrame) -> DataFrame:
    return summary.withColumn("error_rate", ratio(F.col("errors"), F.col("total"))).withColumn("success_rate", ratio(F.col("success"), F.col("total")))


def summarize(samples: DataFrame, key: str) -> DataFrame:
    """(key, total, success, errors, error_rate, success_rate) by one column; rows without a key are left out."""
    return _rates(
        samples.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("*").alias("total"),
            F.coalesce(F.sum("relax_success"), F.lit(0)).cast("bigint").alias("success"),
            F.coalesce(F.sum("relax_error"), F.lit(0)).cast("bigint").alias("errors"),
        )
    )


def log_flags(records: DataFrame, skipped_is_success: bool = False) -> DataFrame:
    """Records of a log with relax_error and relax_success; runs in other states count in neither."""
    good = ["success", "skipped_existing_relaxed"] if skipped_is_success else ["success"]
    return records.withColumn("relax_error", (F.col("status") == "error").cast("int")).withColumn("relax_success", F.col("status").isin(good).cast("int"))


def value_counts(df: DataFrame, column: str, keep_missing: bool) -> DataFrame:
    """(column, n), most frequent first, ties by value; missing values counted or left out."""
    rows = df if keep_missing else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last())


def error_rate(samples: DataFrame, key: str) -> DataFrame:
    """(key, error_rate): the mean of the error flag, in order of the key."""
    return samples.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg("relax_error").alias("error_rate")).orderBy(key)


def pending(unrelaxed: DataFrame, relaxed: DataFrame, on: list[str]) -> DataFrame:
    """The work list: what has no counterpart yet."""
    return unrelaxed.join(relaxed.select(*on), on, "left_anti")


def done(unrelaxed: DataFrame, relaxed: DataFrame, on: list[str]) -> DataFrame:
    """What has a counterpart."""
    return unrelaxed.join(relaxed.select(*on), on, "left_semi")
