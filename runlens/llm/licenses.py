"""License scans: sparse TF-IDF cosine of lines and licence files to templates, then inheritance along directories.

Templates are notices, as they stand in headers, and full texts.  Passages are the lines of every file, and also the whole text of files with a
licence file's name; lines are compared with the notices, whole texts with all templates.  A passage's vector has for
each term (a run of a-z and 0-9 after lower-casing) its count times ln((1 + N) / (1 + df)) + 1, where N counts all files with a
text and df those of them that have the term.  Template terms get their df from all files; other terms get that of a term no
file has, which only lowers a cosine.  A file's own licence is its passage's best template at ``threshold`` or more.

A file without one inherits from the nearest directory, its own or an ancestor, whose licence files have a licence.  That is
settled once for each directory by joining its ancestors' paths, and then reaches files by a join on their directory.

Only built-in functions run here.  Most lines are passed over by one regular expression: a line can only reach the threshold if it has one
of a template's heavy terms, for the others together are too light.  Template terms (``MOST_TERMS`` at most) enter
the plan as literals.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import materialise, others, plain
from .licence_texts import NOTICE, TEMPLATES, TEXT

THRESHOLD = 0.8
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([._-].*)?$"
#: Templates' terms, and bytes of a table of templates, at most; larger ones are refused.
MOST_TERMS, MOST_TEMPLATE_BYTES = 2000, 4 << 20
Template = tuple[str, str, str]
_TERM = re.compile("[a-z0-9]+")


def terms(text: Column) -> Column:
    """A text's terms in order."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names, strict=True)]) for r in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs))).select(*[F.expr(f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}") for c in schema.split(", ")])


class Weights:
    """The templates' vectors for given term statistics."""

    def __init__(self, templates: Sequence[Template], n: int, df: dict[str, int], threshold: float) -> None:
        self.rare = math.log(1.0 + n) + 1.0
        counts = [(name, kind, Counter(_TERM.findall(text.lower()))) for name, kind, text in templates]
        self.idf = {t: math.log((1.0 + n) / (1.0 + df.get(t, 0))) + 1.0 for *_, c in counts for t in c}
        #: (template, licence, kind, term, weight); terms that a line needs one of to be near a notice.
        self.vectors, heavy = [], set()
        for k, (name, kind, own) in enumerate(counts):
            weighed = sorted((c * self.idf[t], t) for t, c in own.items())
            norm2 = sum(w * w for w, _ in weighed)
            self.vectors += [(k, name, kind, t, w / math.sqrt(norm2)) for w, t in weighed]
            light = 0.0
            for w, t in weighed:
                light += w * w
                if kind == NOTICE and light >= (threshold * (1 - 1e-9)) ** 2 * norm2:
                    heavy.add(t)
        self.heavy = sorted(heavy)


def _templates(templates: Sequence[Template] | DataFrame) -> list[Template]:
    """The templates as a list; of a table (licence, kind, text) its bytes are checked first.  Templates without a term are left out."""
    if isinstance(templates, DataFrame):
        rows = templates.select("licence", "kind", "text").where("licence is not null and text is not null")
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        if size > MOST_TEMPLATE_BYTES:
            raise ValueError("the templates have more bytes than MOST_TEMPLATE_BYTES")
        templates = [tuple(r) for r in rows.distinct().orderBy("licence", "kind", "text").collect()]
    for licence, kind, _ in templates:
        if kind not in (NOTICE, TEXT):
            raise ValueError(f"no kind of template: {licence}, {kind}")
    return [t for t in templates if _TERM.search(t[2].lower())]


def _weights(texts: DataFrame, templates: Sequence[Template], threshold: float) -> Weights:
    """The templates' vectors by the statistics of all texts; what comes to the driver is a count for each template term."""
    vocabulary = sorted({t for *_, text in templates for t in _TERM.findall(text.lower())})
    if len(vocabulary) > MOST_TERMS:
        raise ValueError("the templates have more terms than MOST_TERMS")
    wanted = F.array(*[F.lit(t) for t in vocabulary]).cast("array<string>")
    seen = texts.where("text is not null").select(F.array_append(F.array_intersect(terms(F.col("text")), wanted), "").alias("found"))
    df = {r["term"]: r["n"] for r in seen.select(F.explode("found").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    return Weights(templates, df.get("", 0), df, threshold)  # '' counts the texts


def _passages(path: Column, text: Column, weights: Weights) -> Column:
    """(line, passage) of all whole licence files (line 0), and of all lines, counted from 1, with a heavy term."""
    heavy = f"(?<![a-z0-9])(?:{'|'.join(weights.heavy)})(?![a-z0-9])" if weights.heavy else "(?!)"
    none = F.array().cast("array<struct<line: int, passage: string>>")
    numbered = F.transform(F.split(text, r"\r\n|\n|\r"), lambda x, i: F.struct((i + 1).alias("line"), x.alias("passage")))
    is_file = F.element_at(F.split(path, "/"), -1).rlike(LICENCE_FILE)
    whole = F.when(is_file, F.array(F.struct(F.lit(0).alias("line"), text.alias("passage")))).otherwise(none)
    lines = F.when(F.lower(text).rlike(heavy), F.filter(numbered, lambda p: F.lower(p["passage"]).rlike(heavy))).otherwise(none)
    return F.coalesce(F.concat(whole, lines), none)


def _best(passages: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """(file, licence, score, line): of a file's passages that with the highest cosine (to 9 decimals), of equal ones the earlier, then
    the template's name."""
    counted = passages.select("file", "line", F.explode(terms(F.col("passage"))).alias("term")).groupBy("file", "line", "term").agg(F.count("*").alias("tf"))
    idf = F.create_map(*[F.lit(x) for pair in sorted(weights.idf.items()) for x in pair])
    weighed = counted.withColumn("w", F.col("tf") * F.coalesce(F.try_element_at(idf, F.col("term")), F.lit(weights.rare)))
    norms = weighed.groupBy("file", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    vectors = _literal_table(passages.sparkSession, weights.vectors, "template int, licence string, kind string, term string, tw double")
    met = weighed.join(F.broadcast(vectors), "term").where((F.col("line") == 0) | (F.col("kind") == NOTICE))
    dots = met.groupBy("file", "line", "template").agg(F.first("licence").alias("licence"), F.sum(F.col("w") * F.col("tw")).alias("dot"))
    near = dots.join(norms, ["file", "line"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= threshold)
    best = near.groupBy("file").agg(F.min(F.struct((-F.col("score")).alias("s"), "line", "licence", "score")).alias("b"))
    return best.select("file", "b.licence", "b.score", "b.line")


def directory(path: Column) -> Column:
    """The path up to its last slash; empty for a file at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    templates: Sequence[Template] | DataFrame = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``files`` without its texts, with the columns licence, licence_score, licence_line and licence_from; columns of those names, in any case, are replaced.

    licence_from is the file's own path, or the directory whose licence file it inherits from ('' is the top); all four are null where
    nothing is found.  If a directory has several licence files with a licence, the one with the highest score counts, then the least path.
    Null and empty texts have no licence of their own but can inherit; a null path never inherits.  Rows with one path are files of
    their own.  An empty table gives an empty one.  ``templates`` may be a table (licence, kind, text); a kind is notice or text.
    """
    new = ("licence", "licence_score", "licence_line", "licence_from")
    rows, path, text = plain(files, path_col, text_col)
    keep = [i for i in others(files.columns, new) if f"c{i}" != text]
    rows = rows.select(F.struct(*[F.col(f"c{i}") for i in keep]).alias("row"), F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    weights = _weights(rows.select("text"), _templates(templates), threshold)
    if not weights.vectors:
        none = [F.lit(None).cast(t) for t in ("string", "double", "int", "string")]
        return rows.select("row.*", *none).toDF(*[files.columns[i] for i in keep], *new)
    some = _passages(F.col("path"), F.col("text"), weights)
    # A row's number brings a passage back to its row; written down, it stays the same whatever is computed again.
    keyed = materialise(rows.select(F.monotonically_increasing_id().alias("file"), "row", "path", some.alias("some")), "passages")
    found = _best(keyed.select("file", F.inline("some")), weights, threshold)
    judged = keyed.select("file", "row", "path").join(found, "file", "left")
    judged = judged.withColumn("dir", directory(F.col("path")))
    holds = F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE) & F.col("licence").isNotNull()
    granted = judged.where(holds).groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "licence", "score")).alias("g"))
    granted = granted.select(F.col("dir").alias("from"), F.col("g.licence").alias("dir_licence"), F.col("g.score").alias("dir_score"))
    steps = F.split("dir", "/")
    lines = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    ancestors = judged.where("path is not null").select("dir").distinct().select("dir", F.posexplode(F.array_distinct(lines)).alias("depth", "from"))
    nearest = ancestors.join(granted, "from").groupBy("dir").agg(F.max(F.struct("depth", "from", "dir_licence", "dir_score")).alias("n"))
    # Written down, so that the join is one of plain tables and a directory of very many files can be split over tasks.
    both = judged.join(materialise(nearest, "directories"), "dir", "left")
    has = F.col("licence").isNotNull()
    return both.select(
        "row.*",
        F.coalesce("licence", "n.dir_licence").alias("licence"),
        F.coalesce("score", "n.dir_score").alias("licence_score"),
        F.when(has, F.col("line")).alias("licence_line"),
        F.when(has, F.col("path")).otherwise(F.col("n.from")).alias("licence_from"),
    ).toDF(*[files.columns[i] for i in keep], *new)
