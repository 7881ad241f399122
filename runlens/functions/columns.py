"""Projections, flags and the missing-value rules that all tables follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN null in every floating column, so that there is one kind of missing value."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns])


def project_keep(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns of ``keep`` that the table has, in that order."""
    return df.select(*[c for c in keep if c in df.columns])


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """The table itself, or an error that lists the missing columns in order."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def default_column(df: DataFrame, name: str, default: object = "") -> Column:
    """A column, or a constant where the table doesn't have it."""
    return (F.col(name) if name in df.columns else F.lit(default)).alias(name)


def where_if_present(df: DataFrame, name: str, value: object) -> DataFrame:
    """Rows with a value in a column; all rows if there is no such column."""
    return df.where(F.col(name) == value) if name in df.columns else df


def status_flags(exists: Column) -> tuple[Column, Column, Column]:
    """(status, relax_success, relax_error) from whether the relaxed file exists."""
    return (
        F.when(exists, "success").otherwise("error").alias("status"),
        exists.cast("int").alias("relax_success"),
        (~exists).cast("int").alias("relax_error"),
    )


def threshold_flags(success: Column, full: int = 5) -> tuple[Column, Column, Column]:
    """1 where the number of successes is ``full``, and at least ``full`` - 1 and - 2."""
    return (
        (success == full).cast("int").alias("all5_success"),
        (success >= full - 1).cast("int").alias("atleast4_success"),
        (success >= full - 2).cast("int").alias("atleast3_success"),
    )


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a.cast("double"), b)


def chain_key(entry: Column, chain: Column) -> Column:
    """Lower-cased entry and upper-cased chain, joined by an underscore; a null part is left out."""
    return F.concat_ws("_", F.lower(entry), F.upper(chain))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def last_segment(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)
