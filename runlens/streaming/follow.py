"""Incremental scans: the batch plans over files as they appear.

Each file is seen once, so a finished part of the tree is not read again; the checkpoint of the stream is what a resumed job skips by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chain_from_name, last_segment, loose_key, strict_key
from ..sources.files import ANY_STATE, ca_value

_FILES = "path string, modificationTime timestamp, length long, content binary"


def follow_quality(spark: SparkSession, root: str, files_per_batch: int = 10_000) -> DataFrame:
    """A stream of (epoch, repeat, chain, state, pdb_path, mean/min/max_plddt, num_residues): one row for each new file."""
    stream = spark.readStream.schema("value string").format("text").option("recursiveFileLookup", True).option("pathGlobFilter", ANY_STATE)
    whole = stream.option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).load(root)
    fits, key = strict_key(F.col("path"))
    rows = whole.select(F.col("_metadata.file_path").alias("path"), F.split("value", r"\R").alias("lines")).where(fits)
    values = F.filter(F.transform("lines", ca_value), lambda v: v.isNotNull())
    rows = rows.withColumn("v", values).where(F.size("v") > 0)
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        *[c.alias(n) for n, c in key.items()],
        F.col("path").alias("pdb_path"),
        (total / F.size("v")).alias("mean_plddt"),
        F.array_min("v").alias("min_plddt"),
        F.array_max("v").alias("max_plddt"),
        F.size("v").cast("bigint").alias("num_residues"),
    )


def follow_outcomes(spark: SparkSession, root: str, files_per_batch: int = 10_000, within: str | None = None) -> DataFrame:
    """A streaming aggregate (epoch, repeat, chain, unrelaxed, relaxed): which files of each run have been seen so far.

    Without ``within`` every run is remembered for ever.  With it, say "7 days", a run is closed when no file of it was modified for that long
    behind the newest seen: it can be written in append mode, its state goes, and files later than that open the run anew.
    """
    stream = spark.readStream.schema(_FILES).format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", ANY_STATE)
    files = stream.option("maxFilesPerTrigger", files_per_batch).load(root).select("path", "modificationTime")
    found, key = loose_key(F.col("path"))
    name = F.replace(last_segment(F.col("path")), F.lit("_relaxed.pdb"), F.lit("_unrelaxed.pdb"))
    rows = files.where(found).select(
        key["epoch"].alias("epoch"), key["repeat"].alias("repeat"), chain_from_name(name).alias("chain"), F.col("path").endswith("_unrelaxed.pdb").alias("u"), "modificationTime"
    )
    if within is not None:
        last = F.session_window("modificationTime", within)
        grouped = rows.withWatermark("modificationTime", within).groupBy("epoch", "repeat", "chain", last)
        return grouped.agg(F.max("u").alias("unrelaxed"), F.max(~F.col("u")).alias("relaxed")).drop("session_window")
    return rows.groupBy("epoch", "repeat", "chain").agg(F.max("u").alias("unrelaxed"), F.max(~F.col("u")).alias("relaxed"))
