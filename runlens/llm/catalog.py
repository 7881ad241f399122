"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, licenses, mixing, neighbours, quality, sharding, simhash, suffixes, tokenfile, urls
from ._store import fresh_path, prepare, read_table
from .fingerprint_sql import simhash_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labelled rows that are not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality.held_out()))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it contains."""
    found = decontam.contained(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.round(F.col("found") / F.col("shingles"), 6))


ORACLES["op2_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+') AS w
  FROM benchmark
), bs AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS n,
         unnest([array_to_string(w[i:i + least(len(w), 5) - 1], ' ') for i in range(1, len(w) - least(len(w), 5) + 2)]) AS s
  FROM b WHERE len(w) > 0
), ds AS (
  SELECT DISTINCT doc_id, n, unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) AS s
  FROM d, (SELECT DISTINCT n FROM bs) WHERE len(w) >= n
), q AS (
  SELECT item_id, count(*) AS shingles FROM bs GROUP BY item_id
)
SELECT doc_id, item_id, shingles, count(*) AS found, round(count(*) / shingles, 6) AS containment
FROM ds JOIN bs USING (n, s) JOIN q USING (item_id)
GROUP BY doc_id, item_id, shingles
HAVING count(*) >= 0.8 * shingles
"""


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    judged = urls.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op3_url_filter"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM p
), u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM h
), r(rule, rhost, rpath, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
         ('net/fr/', 'net', '/fr/', 'block')
), f AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host = 'spam-farm.example.org' OR ends_with(host, '.spam-farm.example.org')
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN f USING (page_id)
"""


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.assign(docs)


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps once passages of earlier documents are cut."""
    found = suffixes.remove_repeats(read_table(spark, sf_dir, "documents"), texts=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: Every 50-byte string with the least document that has it; texts are cut up 1,000 starts at a time, since a slice costs its whole text.
ORACLES["op5_suffix_dedup"] = r"""
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), c AS (
  SELECT doc_id, o, b[o + 1:o + 1049] AS p FROM (SELECT doc_id, b, unnest(range(0, octet_length(b), 1000)) AS o FROM d)
), w AS (
  SELECT doc_id, o + i AS i, p[i:i + 49] AS x
  FROM (SELECT doc_id, o, p, unnest(range(1, octet_length(p) - 48)) AS i FROM c)
), again AS (
  SELECT doc_id, i FROM w JOIN (SELECT x, min(doc_id) AS least FROM w GROUP BY x) USING (x) WHERE doc_id > least
), runs AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM again)
), spans AS (
  SELECT doc_id, min(i) AS first, max(i) + 49 AS last FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS before FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(last - first + 1) AS n_removed, max(last) AS ended,
         string_agg(CASE WHEN first - before > 1 THEN hex(b[before + 1:first - 1]) ELSE '' END, '' ORDER BY first) AS kept
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') ||
         CASE WHEN coalesce(ended, 0) < octet_length(b) THEN hex(b[coalesce(ended, 0) + 1:octet_length(b)]) ELSE '' END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


@query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every query vector."""
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence, taken as a file: one in 50 is a licence file of its directory, one in 1000 of its source."""
    chunk = F.floor(F.col("doc_id") / 500).cast("string")
    path = (
        F.when(F.col("doc_id") % 1000 == 0, F.concat_ws("/", "source", F.lit("LICENSE")))
        .when(F.col("doc_id") % 50 == 0, F.concat_ws("/", "source", "lang", chunk, F.lit("LICENSE.txt")))
        .otherwise(F.concat_ws("/", "source", "lang", chunk, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    )
    files = read_table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    found = licenses.scan(files)
    return found.select("doc_id", "path", "licence", F.round("licence_score", 6).alias("licence_score"), "licence_line", "licence_from")


_TEMPLATE_ROWS = ", ".join("({}, '{}', '{}', '{}')".format(k, *(x.replace("'", "''") for x in t)) for k, t in enumerate(licenses.TEMPLATES))
ORACLES["op7_license_scan"] = (
    "WITH t(template, licence, kind, body) AS (VALUES " + _TEMPLATE_ROWS + r"""), f AS (
  SELECT doc_id, text, CASE
    WHEN doc_id % 1000 = 0 THEN source || '/LICENSE'
    WHEN doc_id % 50 = 0 THEN source || '/' || lang || '/' || (doc_id // 500) || '/LICENSE.txt'
    ELSE source || '/' || lang || '/' || (doc_id // 500) || '/' || doc_id || '.txt' END AS path,
    doc_id % 50 = 0 AS holder
  FROM documents
), tt AS (
  SELECT template, licence, kind, term, count(*) AS tf
  FROM (SELECT template, licence, kind, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term FROM t) GROUP BY ALL
), n AS (
  SELECT count(*) AS n FROM f WHERE text IS NOT NULL
), df AS (
  SELECT term, count(*) AS df
  FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM f)
  WHERE term IN (SELECT term FROM tt) GROUP BY term
), idf AS (
  SELECT term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0 AS idf FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term), n
), tv AS (
  SELECT template, licence, kind, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS tw FROM tt JOIN idf USING (term)
), lines AS (
  SELECT doc_id, generate_subscripts(string_split_regex(text, '
|
|
'), 1)::INT AS line,
         unnest(string_split_regex(text, '
|
|
')) AS passage FROM f
  UNION ALL SELECT doc_id, 0, text FROM f WHERE holder
), pt AS (
  SELECT doc_id, line, term, count(*) AS tf
  FROM (SELECT doc_id, line, unnest(regexp_extract_all(lower(passage), '[a-z0-9]+')) AS term FROM lines) GROUP BY ALL
), pw AS (
  SELECT doc_id, line, term, tf * coalesce(idf, (SELECT ln(1.0 + n) + 1.0 FROM n)) AS w FROM pt LEFT JOIN idf USING (term)
), pn AS (
  SELECT doc_id, line, sqrt(sum(w * w)) AS norm FROM pw GROUP BY ALL
), near AS (
  SELECT doc_id, line, template, any_value(licence) AS licence, round(sum(w * tw) / any_value(norm), 9) AS score
  FROM pw JOIN tv USING (term) JOIN pn USING (doc_id, line) WHERE line = 0 OR kind = 'notice' GROUP BY doc_id, line, template
  HAVING round(sum(w * tw) / any_value(norm), 9) >= 0.8
), own AS (
  SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line, licence) = 1
), j AS (
  SELECT f.doc_id, path, holder, licence, score, line, regexp_replace(path, '/?[^/]*$', '') AS dir FROM f LEFT JOIN own USING (doc_id)
), g AS (
  SELECT * FROM j WHERE holder AND licence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) = 1
), near_dir AS (
  SELECT j.doc_id, g.dir AS d, g.licence AS dl, g.score AS ds
  FROM j JOIN g ON j.dir = g.dir OR starts_with(j.dir, g.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY j.doc_id ORDER BY length(g.dir) DESC) = 1
)
SELECT doc_id, path, coalesce(licence, dl) AS licence, round(coalesce(score, ds), 6) AS licence_score,
       CASE WHEN licence IS NOT NULL THEN line END AS licence_line, CASE WHEN licence IS NOT NULL THEN path ELSE d END AS licence_from
FROM j LEFT JOIN near_dir USING (doc_id)
"""
)


#: The tokenizer's file; where it lies is a parameter of the operator.
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op8_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a token store, as read back from its files."""
    path = fresh_path(spark, "tokens")
    tokenfile.write(read_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return tokenfile.read(spark, path)


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents."""
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id")


ORACLES["op9_simhash_near_dedup"] = simhash_sql(words=4, seed=42, max_bits=4)


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's share in a mix of all sources."""
    found = mixing.sample(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLES["op10_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), c AS (
  SELECT count(*) AS n FROM d GROUP BY source, CASE WHEN size > 0 THEN floor(log2(size) * 4) ELSE -1 END
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s
), w AS (
  SELECT *, [3.0, 1.0, 2.0][rank % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM r
), l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
             - coalesce((SELECT sum(v.cap) FROM w v WHERE (v.cap / v.weight, v.rank) < (w.cap / w.weight, w.rank)), 0))
            / (SELECT sum(v.weight) FROM w v WHERE (v.cap / v.weight, v.rank) >= (w.cap / w.weight, w.rank)) AS level
  FROM w
), t AS (
  SELECT source, source_size,
         least(cap, weight * (SELECT arg_min(level, (cap / weight, rank)) FROM l WHERE level <= cap / weight)) AS target
  FROM l
), n AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         row_number() OVER (PARTITION BY d.source ORDER BY
           CASE WHEN size > 0 THEN floor(log2(size) * 4) ELSE -1 END DESC,
           ('0x' || substr(digest, 1, 6))::BIGINT % (SELECT greatest(16, (max(n) + 99999) // 100000) FROM c), digest, size) AS k,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('0/' || coalesce('=' || d.source, '-')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size::BIGINT AS size, source_size, target,
       ((floor(k * rate + start) - floor((k - 1) * rate + start)) * size)::BIGINT AS taken
FROM n
"""
