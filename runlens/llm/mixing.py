"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies, target / size of the source.  Documents stand in
an order, largest first; the running sum of expected copies plus one random offset per source crosses an integer
now and then, and a document is emitted once for each integer crossed.  Standing next to documents of like size, every size
class gets its share to within a copy, so a source's words come close to its target.

The order is two-level so that no task holds a source: a class of size and a share of the id's digest form a
bucket, buckets are counted and summed up, and documents are numbered inside buckets.  The number of shares follows from the
rows of the largest class, so buckets stay of one size however large a source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import materialise, plain

#: A word is a run of characters outside space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
#: Classes of size for each doubling, shares of each class at least, and rows of a share on average at most.
CLASSES, SHARES, SHARE_ROWS = 4, 16, 100_000


def words(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sources: DataFrame,
    source_col: str = "source",
    size_col: str = "source_size",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """``sources`` (one row for each, with its size) with the column target.

    Sources by code point, null last, weigh ``weights`` over and over, and share ``share`` times the sum of sizes; a target
    stops at ``most`` times its source's size and the excess is reshared by weight among the rest until none is above.
    In order of cap / weight the first sources are capped; what all others get for each unit of weight follows from
    sums over the sources before and after.  If even all caps don't reach the share, every target is its cap.
    """
    own = sources.columns
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = (
        sources.withColumn("_rank", F.row_number().over(Window.orderBy(F.col(source_col).asc_nulls_last())) - 1)
        .withColumn("_weight", weight)
        .withColumn("_cap", F.lit(float(most)) * F.col(size_col))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    order, whole = Window.orderBy("_ratio", "_rank"), Window.partitionBy()
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.lit(float(share)) * F.sum(size_col).over(whole)
    leveled = ranked.withColumn("_level", (total - before) / after)
    free = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_level"))
    found = leveled.withColumn("_found", F.min(free).over(whole)["_level"])
    target = F.least(F.col("_cap"), F.coalesce(F.col("_found") * F.col("_weight"), F.col("_cap")))
    return found.withColumn("target", target).select(*own, "target")


def _unit(text: Column) -> Column:
    """A number from 0 up to 1 from a text's digest."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def _copies(
    docs: DataFrame,
    whole: bool,
    id_col: str,
    text_col: str,
    source_col: str,
    weights: tuple[float, ...],
    share: float,
    most: float,
    seed: int,
) -> DataFrame:
    """(row, size, source_size, target, copies): row is a struct (p0, p1, ...) of all columns (``whole``) or of id and source.

    What the sums need is written down, so that words are counted once and not for each of them.
    """
    docs, id_, text, source = plain(docs, id_col, text_col, source_col)
    payload = docs.columns if whole else [id_, source]
    source = F.col(source).cast("string")
    size = words(F.col(text))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_).cast("string"), F.lit(""))))
    rows = docs.select(
        F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(payload)]).alias("row"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("-")).alias("key"),  # "-": the null source
        size.alias("size"),
        digest.alias("digest"),
    )
    rows = rows.withColumn(
        "class", F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")) * CLASSES)).otherwise(-1).cast("int")
    )
    narrow = materialise(rows.drop("row") if whole else rows, "sizes")
    rows = rows if whole else narrow
    largest = narrow.groupBy("key", "class").count().agg(F.max("count")).first()[0] or 0
    share_of = F.conv(F.substring("digest", 1, 6), 16, 10).cast("int") % max(SHARES, -(-largest // SHARE_ROWS))
    rows, narrow = rows.withColumn("part", share_of), narrow.withColumn("part", share_of)
    buckets = narrow.groupBy("key", "class", "part").agg(
        F.first("source").alias("source"), F.count("*").alias("n"), F.sum("size").alias("words")
    )
    sizes = buckets.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    totals = targets(sizes, weights=weights, share=share, most=most).select("key", "source_size", "target")
    running = Window.partitionBy("key").orderBy(F.desc("class"), "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        buckets.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0)))
        .select("key", "class", "part", "before")
        .join(totals, "key")
    )
    inside = Window.partitionBy("key", "class", "part").orderBy("digest", "size")
    numbered = rows.withColumn("i", F.row_number().over(inside)).join(starts, ["key", "class", "part"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("before") + F.col("i")
    offset = _unit(F.concat(F.lit(f"{seed}/"), F.col("key")))
    copies = F.floor(at * rate + offset) - F.floor((at - 1) * rate + offset)
    return numbered.select(
        "row", "size", F.col("source_size").cast("long").alias("source_size"), "target", copies.cast("long").alias("copies")
    )


def sample(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, source, size, source_size, target, copies), texts left behind.

    size counts words (null and empty texts: 0), copies is how often the mix takes the document.  A source without
    words has target 0 and gives no copies.  Null sources are one source, apart from one named by an empty text.  Repeated
    rows count each; order ties are broken by the id's digest and size, and rows that tie in both are interchangeable.
    The same rows and seed give the same copies.  An empty table gives an empty one.  Other columns are ignored.
    """
    found = _copies(docs, False, id_col, text_col, source_col, weights, share, most, seed)
    return found.select(
        F.col("row.p0").alias("doc_id"), F.col("row.p1").alias("source"), "size", "source_size", "target", "copies"
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
    seed: int = 0,
) -> DataFrame:
    """The mix itself: each row of ``docs``, all its columns, as often as ``sample`` takes it."""
    found = _copies(docs, True, id_col, text_col, source_col, weights, share, most, seed)
    found = found.where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
    return found.select("row.*").toDF(*docs.columns)
