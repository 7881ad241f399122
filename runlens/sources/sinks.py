"""Sinks.  Spark's commit protocol publishes a folder whole or not at all."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from .files import read_csv_by_name


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A headed CSV folder; an empty table still has its header.  ``one_file`` is for summaries of a few rows."""
    (df.coalesce(1) if one_file else df).write.option("header", True).mode("overwrite").csv(path)


def write_matrix(df: DataFrame, path: str) -> None:
    """A pivoted matrix; its row key is an ordinary first column."""
    write_csv(df, path, one_file=True)


def write_text(text: str, path: str, df: DataFrame) -> None:
    """A report, through the session of ``df``."""
    df.sparkSession.range(1).selectExpr("cast(null as string) as value").na.fill(text, ["value"]).coalesce(1).write.mode("overwrite").text(path)


def copy_csv(spark: SparkSession, source: str, target: str) -> bool:
    """Pass a headed CSV summary on as it is, every column as text; False, and nothing written, where there is none."""
    try:
        table = read_csv_by_name(spark, source)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    write_csv(table, target, one_file=True)
    return True


def preview(df: DataFrame, n: int = 10) -> tuple[int, list[Row]]:
    """The number of rows, and ``n`` of them as they come."""
    return df.count(), df.limit(n).collect()
