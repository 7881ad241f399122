"""Folding job logs into run records.

A log is read line by line; the first rule that fits a line counts:

1. ``Skip`` and ``relaxed`` occur: the path after the first colon gets a record, in the state skipped unless it has another.
2. ``Relaxing:`` occurs: its path's record is running, and is the current one.
3. starts with ``Saved:``: success, and current.
4. starts with ``Violations:``: the current record's violations.
5. starts with ``ERROR processing:``: error, and current.
6. other text while the current record's last event is an error: the record's message, if it has none yet and the text is not empty and
   doesn't start with ``[``.

Lines whose path has no run dimensions have no effect.  As relational algebra: every line gets its kind and key by expressions; the
current record is the last event before a line, a window in the order of lines within a file; one aggregate for each record then
takes last states and first messages.  State never crosses files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strip
from ..functions.columns import nan_to_null

#: How a log names a run, and the states that it can be in.
KEY = r"epoch_(\d+)/.*?repeat_(\d+)/predictions/(.+?)_model_1_(unrelaxed|relaxed)\.pdb"
SKIPPED = "skipped_existing_relaxed"
_STATES = {"relaxing": "running", "saved": "success", "error": "error"}


def _after(text: Column, mark: str) -> Column:
    return strip(F.substring(text, F.instr(text, mark) + len(mark), F.length(text)))


def fold(lines: DataFrame, file_col: str = "file", pos_col: str = "pos", line_col: str = "line") -> DataFrame:
    """(file, epoch, repeat, chain, status, error_message, violations, violations_raw, source_path) of (file, pos, line).

    ``pos`` must be unique within a file.  A violations text that is no number is kept in violations_raw alone.  A skip line's source
    path is cleaned: it starts at the first slash.  Null lines say nothing; an empty table gives an empty one.
    """
    text = strip(F.coalesce(F.col(line_col), F.lit("")))
    line = F.col("text")
    kind = (
        F.when(line.contains("Skip") & line.contains("relaxed"), "skip")
        .when(line.contains("Relaxing:"), "relaxing")
        .when(line.startswith("Saved:"), "saved")
        .when(line.startswith("Violations:"), "violations")
        .when(line.startswith("ERROR processing:"), "error")
        .otherwise("text")
    )
    body = (
        F.when(F.col("kind") == "skip", _after(F.col("text"), ":"))
        .when(F.col("kind") == "relaxing", _after(F.col("text"), "Relaxing:"))
        .when(F.col("kind") == "saved", _after(F.col("text"), "Saved:"))
        .when(F.col("kind") == "violations", _after(F.col("text"), "Violations:"))
        .when(F.col("kind") == "error", _after(F.col("text"), "ERROR processing:"))
        .otherwise(F.col("text"))
    )
    rows = lines.select(F.col(file_col).alias("file"), F.col(pos_col).alias("pos"), text.alias("text")).withColumn("kind", kind)
    rows = rows.withColumn("body", body).withColumn("own", F.when(F.col("kind").isin("skip", *_STATES), F.regexp_extract("body", KEY, 0)))
    parts = F.struct(*[F.regexp_extract("body", KEY, i).alias(n) for i, n in ((1, "e"), (2, "r"), (3, "c"))])
    rows = rows.withColumn("key", F.when(F.col("own") != "", parts))
    # A line that names no run moves nothing, so only named events are seen by the lines after them.
    event = F.when(F.col("kind").isin(*_STATES) & F.col("key").isNotNull(), F.struct("key", "kind"))
    inside = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("current", F.last(event, ignorenulls=True).over(inside))
    is_text = (F.col("kind") == "text") & (F.col("text") != "") & ~F.col("text").startswith("[") & (F.col("current.kind") == "error")
    rows = rows.withColumn("use", F.when(F.col("kind") == "text", is_text).otherwise(True))
    rows = rows.withColumn("record", F.when(F.col("kind").isin("text", "violations"), F.col("current.key")).otherwise(F.col("key")))
    rows = rows.where("use and record is not null")
    of = lambda *kinds: F.col("kind").isin(*kinds)
    folded = rows.groupBy("file", "record").agg(
        F.max_by("kind", F.when(of(*_STATES), F.col("pos"))).alias("last_kind"),
        F.max(of(*_STATES)).alias("has_event"),
        F.max(of("skip", *_STATES)).alias("has_record"),
        F.min_by("text", F.when(of("text"), F.col("pos"))).alias("error_message"),
        F.max_by("body", F.when(of("violations"), F.col("pos"))).alias("violations_raw"),
        F.max_by("body", F.when(of(*_STATES), F.col("pos"))).alias("event_path"),
        F.min_by("body", F.when(of("skip"), F.col("pos"))).alias("skip_path"),
    )
    status = F.when(~F.col("has_event"), SKIPPED)
    for k, s in _STATES.items():
        status = status.when(F.col("last_kind") == k, s)
    out = folded.where("has_record").select(
        "file",
        F.col("record.e").try_cast("int").alias("epoch"),
        F.col("record.r").try_cast("int").alias("repeat"),
        F.col("record.c").alias("chain"),
        status.alias("status"),
        "error_message",
        F.col("violations_raw").try_cast("double").alias("violations"),
        "violations_raw",
        F.when(F.col("has_event"), F.col("event_path")).otherwise(F.regexp_extract("skip_path", "/.*", 0)).alias("source_path"),
    )
    return nan_to_null(out)
