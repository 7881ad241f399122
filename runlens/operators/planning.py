"""Run plans: which model, checkpoint and seed each run of a sweep gets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The last epoch of each step, and the block that runs up to there use.
STEPS = ((7, "ep10"), (14, "ep15"), (20, "ep21"), (26, "ep27"))
LAST_BLOCK = "ep33"
#: Epochs (first, last) of the named sweeps.
PRESETS = {
    "all": (0, 32),
    "half1": (0, 14),
    "half2": (15, 32),
    "v4": (0, 7),
    "v5": (8, 14),
    "v6": (15, 20),
    "v7": (21, 26),
    "v8": (32, 32),
    "v9": (5, 7),
    "v10": (0, 7),
    "v11": (15, 21),
    "v12": (21, 26),
    "v13": (27, 32),
}


def block(epoch: Column, steps: Sequence[tuple[int, str]] = STEPS, last: str = LAST_BLOCK) -> Column:
    """The block of an epoch: the first step that reaches it."""
    out = F.when(epoch.isNull(), F.lit(None).cast("string"))
    for end, name in steps:
        out = out.when(epoch <= end, name)
    return out.otherwise(last)


def run_plan(
    spark: SparkSession, epochs: Sequence[int], repeats: int = 5, models: Sequence[str] = ("",), targets: Sequence[str] = ("",), samples: int = 1
) -> DataFrame:
    """(model, target, epoch, repeat, sample, seed, step, block): one row for each run of the sweep.

    Seeds are 1000 + repeat and steps (epoch + 1) * 10000.  ``samples`` asks for several relaxations of each prediction.
    """
    def values(xs, name, kind):
        return F.explode(F.array(*[F.lit(x) for x in xs]).cast(f"array<{kind}>")).alias(name)

    plan = spark.range(1, numPartitions=1).select(values(models, "model", "string"))
    plan = plan.select("*", values(targets, "target", "string"))
    plan = plan.select("*", values(epochs, "epoch", "int"))
    plan = plan.select("*", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat"))
    plan = plan.select("*", F.explode(F.sequence(F.lit(1), F.lit(samples))).alias("sample"))
    return plan.select(
        "*", (F.lit(1000) + F.col("repeat")).alias("seed"), ((F.col("epoch") + 1) * 10000).alias("step"), block(F.col("epoch")).alias("block")
    )


def preset(spark: SparkSession, name: str, repeats: int = 5) -> DataFrame:
    """The plan of a named sweep."""
    first, last = PRESETS[name]
    return run_plan(spark, range(first, last + 1), repeats)


def choose_checkpoint(plan: DataFrame, listing: DataFrame, primary: str, archived: str, override: dict[int, str] | None = None) -> DataFrame:
    """``plan`` with the column checkpoint: the first that is listed of an override for the epoch, the primary and the archived path.

    ``primary`` and ``archived`` have {block} and {step}; ``listing`` has a column path.  Runs without any are left out.
    """
    there = listing.select("path").distinct()

    def path(pattern: str) -> Column:
        out = F.replace(F.lit(pattern), F.lit("{block}"), F.col("block"))
        return F.replace(out, F.lit("{step}"), F.col("step").cast("string"))

    first = F.lit(None).cast("string")
    for epoch, own in (override or {}).items():
        first = F.when(F.col("epoch") == epoch, own).otherwise(first)
    out = plan
    for n, c in (("_o", first), ("_p", path(primary)), ("_a", path(archived))):
        out = out.withColumn(n, c).join(there.select(F.col("path").alias(n), F.lit(True).alias(n + "_there")), n, "left")
    found = F.coalesce(*[F.when(F.col(n + "_there"), F.col(n)) for n in ("_o", "_p", "_a")])
    return out.withColumn("checkpoint", found).select(*plan.columns, "checkpoint").where("checkpoint is not null")
