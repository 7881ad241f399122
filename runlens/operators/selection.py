"""Selecting runs, epochs and chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import default_column, ratio, require_columns, threshold_flags, where_if_present


def epoch_chain_counts(samples: DataFrame, full: int = 5) -> DataFrame:
    """Runs, successes, errors, the success rate and threshold flags for each epoch and chain."""
    require_columns(samples, ["epoch", "chain", "relax_success", "relax_error"])
    out = (
        samples.where("epoch is not null and chain is not null")
        .groupBy("epoch", "chain")
        .agg(
            F.count("*").alias("total"),
            F.coalesce(F.sum("relax_success"), F.lit(0)).cast("bigint").alias("success"),
            F.coalesce(F.sum("relax_error"), F.lit(0)).cast("bigint").alias("error"),
        )
    )
    return out.select("*", ratio(F.col("success"), F.col("total")).alias("success_rate"), *threshold_flags(F.col("success"), full))


def at_least(counts: DataFrame, successes: int, exactly: bool = False) -> DataFrame:
    """The epochs and chains with that many successes, in order."""
    found = F.col("success") == successes if exactly else F.col("success") >= successes
    return counts.where(found).orderBy("epoch", "chain")


def pivot(counts: DataFrame, value: str, epochs: Sequence[int] | None = None) -> DataFrame:
    """One row for each chain, one column for each epoch; null where a chain has no such epoch.

    (epoch, chain) must be unique: a pair that occurs twice raises when the matrix is made.
    """
    if epochs is None:
        epochs = [r[0] for r in counts.select("epoch").distinct().orderBy("epoch").collect()]
    cells = counts.groupBy("chain", "epoch").agg(F.count("*").alias("_n"), F.max(value).alias("_v"))
    again = F.raise_error(F.concat(F.lit("duplicate cell: chain "), F.col("chain"), F.lit(", epoch "), F.col("epoch").cast("string")))
    cells = cells.select("chain", "epoch", F.when(F.col("_n") > 1, again.cast(counts.schema[value].dataType)).otherwise(F.col("_v")).alias("_v"))
    return cells.groupBy("chain").pivot("epoch", list(epochs)).agg(F.first("_v"))


def chain_priority(counts: DataFrame) -> DataFrame:
    """Chains in order of their full epochs, then of epochs with one and two less, then of mean successes, then by name."""
    out = counts.groupBy("chain").agg(
        F.count_distinct("epoch").alias("total_epochs"),
        F.sum("success").alias("total_success_runs"),
        F.sum("error").alias("total_error_runs"),
        F.sum("all5_success").alias("num_all5_epochs"),
        F.sum("atleast4_success").alias("num_atleast4_epochs"),
        F.sum("atleast3_success").alias("num_atleast3_epochs"),
        F.avg("success").alias("mean_success_per_epoch"),
    )
    order = ["num_all5_epochs", "num_atleast4_epochs", "num_atleast3_epochs", "mean_success_per_epoch"]
    return out.orderBy(*[F.desc(c) for c in order], "chain")


def first_full(counts: DataFrame) -> DataFrame:
    """First and last full epoch of each chain, and how many there are."""
    return (
        counts.where("all5_success = 1")
        .groupBy("chain")
        .agg(F.min("epoch").alias("first_epoch_all5"), F.max("epoch").alias("last_epoch_all5"), F.count("*").alias("num_all5_epochs"))
        .orderBy("first_epoch_all5", "chain")
    )


def argmax_rows(df: DataFrame, keys: list[str], measure: str, ties: Sequence[Column]) -> DataFrame:
    """For each key the row with the largest measure; ties go to the row that is first by ``ties``, which are ascending.

    One aggregate with a partial step on the map side: no window, so a large group is no large task.  Rows without a measure are left out.
    """
    rank = F.struct(-F.col(measure), *ties)
    best = df.where(F.col(measure).isNotNull()).groupBy(*keys).agg(F.min_by(F.struct(*df.columns), rank).alias("r"))
    return best.select("r.*")


def first_rows(df: DataFrame, keys: list[str], order: Sequence[Column]) -> DataFrame:
    """For each key its first row by ``order``, which is ascending; null keys are one key."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def first_mid_last(df: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    """Of each group in order the rows at positions 0, n // 2 and n - 1; no row comes twice."""
    inside = Window.partitionBy(*keys)
    rows = df.withColumn("_p", F.row_number().over(inside.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(inside))
    wanted = (F.col("_p") == 0) | (F.col("_p") == F.floor(F.col("_n") / 2)) | (F.col("_p") == F.col("_n") - 1)
    return rows.where(wanted).drop("_p", "_n")


def recommend(outcomes: DataFrame, quality: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(best run of each epoch and chain, first/middle/last epoch of each chain) among successful runs with a quality.

    The join doesn't ask for unique keys: a repeated quality row repeats the run.  Missing path columns become empty texts.
    """
    keys = ["epoch", "repeat", "chain"]
    require_columns(outcomes, [*keys, "relax_success"])
    scores = require_columns(where_if_present(quality, "state", "unrelaxed"), [*keys, "mean_plddt"])
    left = outcomes.select(*keys, "relax_success", default_column(outcomes, "relaxed_path"), default_column(outcomes, "unrelaxed_path"))
    good = left.join(scores.select(*keys, "mean_plddt"), keys, "left").where("relax_success = 1 and mean_plddt is not null")
    best = argmax_rows(good, ["epoch", "chain"], "mean_plddt", [F.col("repeat"), F.col("relaxed_path")])
    shown = ["chain", "epoch", "repeat", "mean_plddt", "relaxed_path", "unrelaxed_path"]
    return best.select(*shown).orderBy("chain", "epoch"), first_mid_last(best, ["chain"], ["epoch"]).select(*shown).orderBy("chain", "epoch")


def prepare_chains(chains: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One row for each chain key of model 1, the first in order, with the columns that the table has."""
    from ..functions import chain_key, project_keep

    rows = where_if_present(chains, "model_id", 1)
    keyed = rows.withColumn("chain_key", chain_key(F.col("pdb_id"), F.col("chain_id")))
    return project_keep(first_rows(keyed, ["chain_key"], order), ["chain_key", "pdb_id", "chain_id", "model_id", "chain_length", "seq"])
