"""Sources: each is a plan over Spark's own readers; nothing is listed or opened on the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns, paths

#: The names of result files.
ANY_STATE = "*_{unrelaxed,relaxed}.pdb"
UNRELAXED_ONLY = "*_unrelaxed.pdb"


def list_files(spark: SparkSession, root: str, pattern: str = UNRELAXED_ONLY) -> DataFrame:
    """(path, length) of the files below ``root`` whose names fit; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length")


def tree_stats(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(n_files, n_bytes) of a tree."""
    return list_files(spark, root, pattern).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))


def ca_value(line: Column) -> Column:
    """The value of a fixed-width record's columns 61 to 66 if it is an ATOM record of a CA atom and a number stands there."""
    wanted = line.startswith("ATOM") & (F.trim(F.substring(line, 13, 4)) == "CA")
    value = columns.strip(F.substring(line, 61, 6)).try_cast("double")
    return F.when(wanted & ~F.isnan(value), value)


def read_ca_values(spark: SparkSession, root: str, pattern: str = ANY_STATE) -> DataFrame:
    """(path, value): one row for every CA record with a value.  Records with alternate locations count each."""
    reader = spark.read.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return ca_values(reader.load(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")))


def ca_values(lines: DataFrame) -> DataFrame:
    """(path, value) of (path, line)."""
    return lines.select("path", ca_value(F.col("line")).alias("value")).where("value is not null")


#: The columns of the quality table.
QUALITY_SCHEMA = "epoch int, repeat int, chain string, state string, pdb_path string, mean_plddt double, min_plddt double, max_plddt double, num_residues bigint"


def quality_table(spark: SparkSession, root: str, unrelaxed_only: bool = False, models: str = paths.MODELS) -> DataFrame:
    """One row per file of the strict layout with at least one value: its run dimensions and the statistics of its values.

    Paths are filtered before any statistics are taken; files without values drop out of the aggregate by themselves.
    """
    return quality_of(read_ca_values(spark, root, UNRELAXED_ONLY if unrelaxed_only else ANY_STATE), models)


def quality_of(values: DataFrame, models: str = paths.MODELS) -> DataFrame:
    """The quality table of (path, value), whoever read them."""
    fits, key = paths.strict_key(F.col("path"), models)
    per_file = (
        values.where(fits)
        .groupBy("path")
        .agg(F.avg("value").alias("mean_plddt"), F.min("value").alias("min_plddt"), F.max("value").alias("max_plddt"), F.count("*").alias("num_residues"))
    )
    return per_file.select(
        *[c.alias(n) for n, c in key.items()], F.col("path").alias("pdb_path"), "mean_plddt", "min_plddt", "max_plddt", "num_residues"
    )


def skipped_files(spark: SparkSession, root: str, pattern: str = ANY_STATE, models: str = paths.MODELS) -> DataFrame:
    """The listed files that the strict layout passes over: an unfit tree shows here instead of as an empty result."""
    fits, _ = paths.strict_key(F.col("path"), models)
    return list_files(spark, root, pattern).where(~fits)


def outcome_listing(unrelaxed: DataFrame, relaxed: DataFrame) -> DataFrame:
    """The outcome table from two listings with a column ``path``: a run succeeded if its relaxed counterpart is listed.

    Existence is a join of the listings, not a look-up for each file.  Unrelaxed paths without both markers are left out.
    """
    found, key = paths.loose_key(F.col("path"))
    there = relaxed.select(F.col("path").alias("relaxed_path")).distinct().withColumn("_there", F.lit(True))
    runs = unrelaxed.select("path").distinct().where(found).withColumn("relaxed_path", paths.relaxed_sibling(F.col("path")))
    joined = runs.join(there, "relaxed_path", "left").withColumn("relaxed_exists", F.coalesce("_there", F.lit(False)))
    status, success, error = columns.status_flags(F.col("relaxed_exists"))
    return joined.select(
        key["epoch"].alias("epoch"),
        key["repeat"].alias("repeat"),
        paths.chain_from_name(columns.last_segment(F.col("path"))).alias("chain"),
        status,
        success,
        error,
        F.col("path").alias("unrelaxed_path"),
        "relaxed_path",
        "relaxed_exists",
    )


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line): the lines of job logs, numbered within each file; any line end counts, undecodable bytes are replaced."""
    whole = spark.read.format("text").option("wholetext", True).load(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", r"\R")).alias("pos", "line"))


def read_csv_by_name(spark: SparkSession, path: str, types: Mapping[str, str] | None = None) -> DataFrame:
    """A CSV table with a header: all columns as text, then those of ``types`` cast by name; NaN becomes null.

    Column order doesn't matter, and the texts NA and nan stay texts in text columns.  Values that can't be cast are null.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    types = types or {}
    cast = [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns]
    return columns.nan_to_null(raw.select(*cast))
