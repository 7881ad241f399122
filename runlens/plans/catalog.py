"""The engine's registered queries and their SQL counterparts.

Run outcomes and qualities are played by ``events``: a day is an epoch, an event type an outcome, a value a quality.  ``sample`` is
one row for each event, ``sample1`` the first event of each (epoch, repeat, chain).  Floating results are rounded to six decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chain_from_name, chain_key, last_segment, loose_key, project_keep, relaxed_sibling, strict_key, where_if_present
from ..operators import logfold, outcome, planning, quality, selection, stats
from ..sources import ca_values, outcome_listing, quality_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEYS = ["epoch", "repeat", "chain"]
EPOCHS = range(1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proxy fact table."""
    error = (F.col("event_type") == "error").cast("int")
    return table(spark, sf_dir, "events").select(
        F.day("ts").alias("epoch"),
        (F.col("event_id") % 5 + 1).cast("int").alias("repeat"),
        F.concat(F.lit("c"), (F.col("user_id") % 7).cast("string")).alias("chain"),
        error.alias("relax_error"),
        (1 - error).alias("relax_success"),
        F.when(error == 1, "error").otherwise("success").alias("status"),
        F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("mean_plddt"),
        "event_id",
    )


def sample1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proxy fact table with unique keys."""
    return selection.first_rows(sample(spark, sf_dir), KEYS, [F.col("event_id")])


SAMPLE = """sample AS (
  SELECT day(ts)::INT AS epoch, (event_id % 5 + 1)::INT AS repeat, 'c' || (user_id % 7) AS chain,
         (event_type = 'error')::INT AS relax_error, 1 - (event_type = 'error')::INT AS relax_success,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         CASE WHEN event_id % 11 <> 0 THEN value END AS mean_plddt, event_id
  FROM events
), sample1 AS (
  SELECT * FROM sample QUALIFY row_number() OVER (PARTITION BY epoch, repeat, chain ORDER BY event_id) = 1
)"""


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def add(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(run(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = f"WITH {SAMPLE}\n{sql}" if "sample" in sql else sql


# Outcome summaries

RATES = """count(*) AS total, sum(relax_success)::BIGINT AS success, sum(relax_error)::BIGINT AS errors,
  round(sum(relax_error) / count(*), 6) AS error_rate, round(sum(relax_success) / count(*), 6) AS success_rate"""
for key in KEYS:
    add(f"relax_summary_by_{key}", lambda s, d, k=key: outcome.summarize(sample(s, d), k), f"SELECT {key}, {RATES} FROM sample GROUP BY {key}")
    add(
        f"summary_plddt_by_{key}",
        lambda s, d, k=key: quality.summarize(sample(s, d), k),
        f"""SELECT {key}, {RATES}, round(avg(mean_plddt), 6) AS mean_plddt, round(median(mean_plddt), 6) AS median_plddt,
  round(stddev_samp(mean_plddt), 6) AS std_plddt, round(min(mean_plddt), 6) AS min_plddt, round(max(mean_plddt), 6) AS max_plddt
FROM sample GROUP BY {key}""",
    )
    add(f"mean_plddt_by_{key}", lambda s, d, k=key: quality.mean_quality(sample(s, d), k), f"SELECT {key}, round(avg(mean_plddt), 6) AS mean_plddt FROM sample GROUP BY {key}")
    add(f"error_rate_by_{key}", lambda s, d, k=key: outcome.error_rate(sample(s, d), k), f"SELECT {key}, round(avg(relax_error), 6) AS error_rate FROM sample GROUP BY {key}")

_LOG_STATUS = {"error": "error", "signup": "running", "click": logfold.SKIPPED}


def _log_records(spark: SparkSession, sf_dir: str, skip_ok: bool) -> DataFrame:
    state = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _LOG_STATUS.items() for x in kv]), F.col("event_type")), F.lit("success"))
    rows = table(spark, sf_dir, "events").select(F.day("ts").alias("epoch"), state.alias("status"))
    return outcome.summarize(outcome.log_flags(rows, skip_ok), "epoch")


for name, good in (("relax_summary_log", "('view', 'purchase')"), ("relax_summary_log_skip_ok", "('view', 'purchase', 'click')")):
    add(
        name,
        lambda s, d, ok=name.endswith("skip_ok"): _log_records(s, d, ok),
        f"""SELECT epoch, {RATES} FROM (
  SELECT day(ts)::INT AS epoch, (event_type IN {good})::INT AS relax_success, (event_type = 'error')::INT AS relax_error FROM events)
GROUP BY epoch""",
    )

add(
    "plddt_by_error",
    lambda s, d: quality.by_outcome(sample(s, d)),
    """SELECT relax_error, count(mean_plddt) AS count, round(avg(mean_plddt), 6) AS mean, round(median(mean_plddt), 6) AS median,
  round(stddev_samp(mean_plddt), 6) AS std, round(min(mean_plddt), 6) AS min, round(max(mean_plddt), 6) AS max FROM sample GROUP BY relax_error""",
)
add(
    "box_plddt_by_error",
    lambda s, d: quality.box_inputs(sample(s, d)),
    "SELECT relax_error, "
    + ", ".join(f"round(quantile_cont(mean_plddt, {p}), 6) AS {n}" for p, n in ((0.0, "low"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "high")))
    + " FROM sample WHERE mean_plddt IS NOT NULL GROUP BY relax_error",
)


def _value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type"))
    kept, dropped = outcome.value_counts(rows, "event_type", True), outcome.value_counts(rows, "event_type", False)
    return kept.withColumn("missing", F.lit("kept")).union(dropped.withColumn("missing", F.lit("dropped")))


add(
    "value_counts",
    _value_counts,
    """WITH e AS (SELECT CASE WHEN event_id % 11 <> 0 THEN event_type END AS event_type FROM events)
SELECT event_type, count(*) AS n, 'kept' AS missing FROM e GROUP BY event_type
UNION ALL SELECT event_type, count(*), 'dropped' FROM e WHERE event_type IS NOT NULL GROUP BY event_type""",
)
add(
    "null_profile",
    lambda s, d: sample(s, d).agg(F.count("*").alias("n_rows"), F.count_if(F.col("mean_plddt").isNull()).alias("n_missing")),
    "SELECT count(*) AS n_rows, count(*) FILTER (mean_plddt IS NULL) AS n_missing FROM sample",
)
add(
    "tree_stats",
    lambda s, d: table(s, d, "pages").agg(F.count("*").alias("n_files"), F.sum(F.octet_length("html")).cast("bigint").alias("n_bytes")),
    "SELECT count(*) AS n_files, sum(strlen(html))::BIGINT AS n_bytes FROM pages",
)

# Projections and filters

add(
    "project_keep",
    lambda s, d: project_keep(table(s, d, "customer"), ["c_custkey", "no_such_column", "c_mktsegment", "c_nationkey"]),
    "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer",
)
_URL = "/([a-z]{2})/([0-9]+)"
add(
    "regex_extract",
    lambda s, d: table(s, d, "pages")
    .where(F.col("url").rlike(_URL))
    .select("page_id", F.regexp_extract("url", _URL, 1).alias("lang"), F.regexp_extract("url", _URL, 2).cast("int").alias("number")),
    f"SELECT page_id, regexp_extract(url, '{_URL}', 1) AS lang, regexp_extract(url, '{_URL}', 2)::INT AS number FROM pages WHERE regexp_matches(url, '{_URL}')",
)
add(
    "string_replace",
    lambda s, d: table(s, d, "part").select(
        "p_partkey", F.replace("p_name", F.lit("a"), F.lit("_")).alias("name"), F.substring_index("p_type", " ", -1).alias("last"), F.col("p_type").endswith("L").alias("ends")
    ),
    "SELECT p_partkey, replace(p_name, 'a', '_') AS name, string_split(p_type, ' ')[-1] AS last, ends_with(p_type, 'L') AS ends FROM part",
)
add(
    "status_flags",
    lambda s, d: sample(s, d).select("event_id", "status", F.col("status").isin("success", "skipped").cast("int").alias("good"), (F.col("status") == "error").cast("int").alias("bad")),
    "SELECT event_id, status, (status IN ('success', 'skipped'))::INT AS good, (status = 'error')::INT AS bad FROM sample",
)
add(
    "chain_key",
    lambda s, d: table(s, d, "customer").select("c_custkey", chain_key(F.col("c_mktsegment"), F.col("c_name")).alias("key")),
    "SELECT c_custkey, lower(c_mktsegment) || '_' || upper(c_name) AS key FROM customer",
)
add(
    "filter_optional",
    lambda s, d: where_if_present(where_if_present(sample(s, d), "status", "error"), "model_id", 1).select("event_id", "epoch", "chain"),
    "SELECT event_id, epoch, chain FROM sample WHERE status = 'error'",
)
add(
    "filter_conj",
    lambda s, d: sample(s, d).where((F.col("relax_success") == 1) & F.col("mean_plddt").isNotNull()).select("event_id", "mean_plddt"),
    "SELECT event_id, round(mean_plddt, 6) AS mean_plddt FROM sample WHERE relax_success = 1 AND mean_plddt IS NOT NULL",
)

# Joins

add(
    "join_left_validated",
    lambda s, d: quality.join_validated(
        sample1(s, d).select(*KEYS, "status"), sample1(s, d).where("event_id % 3 != 0").select(*KEYS, "mean_plddt")
    ),
    """SELECT a.epoch, a.repeat, a.chain, a.status, round(b.mean_plddt, 6) AS mean_plddt
FROM sample1 a LEFT JOIN (SELECT * FROM sample1 WHERE event_id % 3 <> 0) b USING (epoch, repeat, chain)""",
)
add(
    "join_left",
    lambda s, d: table(s, d, "documents").select("doc_id", "lang").join(table(s, d, "labels"), "doc_id", "left"),
    "SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
add(
    "join_semi",
    lambda s, d: outcome.done(table(s, d, "documents").select("doc_id", "source"), table(s, d, "labels"), ["doc_id"]),
    "SELECT doc_id, source FROM documents SEMI JOIN labels USING (doc_id)",
)
add(
    "join_anti",
    lambda s, d: outcome.pending(table(s, d, "documents").select("doc_id", "source"), table(s, d, "labels"), ["doc_id"]),
    "SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)",
)
_CASE = "CASE WHEN epoch <= 7 THEN 'ep10' WHEN epoch <= 14 THEN 'ep15' WHEN epoch <= 20 THEN 'ep21' WHEN epoch <= 26 THEN 'ep27' ELSE 'ep33' END"
add(
    "range_case",
    lambda s, d: sample(s, d).select("event_id", "epoch", planning.block(F.col("epoch")).alias("block")),
    f"SELECT event_id, epoch, {_CASE} AS block FROM sample",
)
add(
    "run_plan",
    lambda s, d: planning.preset(s, "all").select("epoch", "repeat", "seed", "step", "block"),
    f"""SELECT epoch::INT AS epoch, repeat::INT AS repeat, (1000 + repeat)::INT AS seed, ((epoch + 1) * 10000)::INT AS step, {_CASE} AS block
FROM range(0, 33) e(epoch), range(1, 6) r(repeat)""",
)

add(
    "run_plan_models",
    lambda s, d: planning.run_plan(s, [32], 5, models=["base", "early", "late"], targets=["t1", "t2"], samples=5).select("model", "target", "epoch", "repeat", "sample", "seed"),
    """SELECT model, target, 32 AS epoch, repeat::INT AS repeat, sample::INT AS sample, (1000 + repeat)::INT AS seed
FROM (VALUES ('base'), ('early'), ('late')) m(model), (VALUES ('t1'), ('t2')) t(target), range(1, 6) r(repeat), range(1, 6) x(sample)""",
)


def _checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which anything was bought have a primary checkpoint, even days an archived one."""
    days = sample(spark, sf_dir).where("event_id % 37 = 0").select("epoch").distinct()
    days = days.select("epoch", planning.block(F.col("epoch")).alias("block"), ((F.col("epoch") + 1) * 10000).alias("step"))
    name = F.concat(F.col("block"), F.lit("/"), F.col("step").cast("string"))
    listing = days.select(F.concat(F.lit("/p/"), name).alias("path")).union(days.where("epoch % 2 = 0").select(F.concat(F.lit("/a/"), name)))
    listing = listing.union(spark.range(1).select(F.lit("/own/30").alias("path")))
    plan = planning.run_plan(spark, range(1, 34), 1)
    return planning.choose_checkpoint(plan, listing, "/p/{block}/{step}", "/a/{block}/{step}", {30: "/own/30"}).select("epoch", "checkpoint")


add(
    "checkpoint_choice",
    _checkpoints,
    f"""SELECT DISTINCT epoch, CASE WHEN epoch = 30 THEN '/own/30' ELSE '/p/' || {_CASE} || '/' || ((epoch + 1) * 10000) END AS checkpoint
FROM sample WHERE event_id % 37 = 0 OR epoch = 30""",
)

# Selection

COUNTS = """counts AS (
  SELECT epoch, chain, count(*) AS total, sum(relax_success)::BIGINT AS success, sum(relax_error)::BIGINT AS error,
    round(sum(relax_success) / count(*), 6) AS success_rate, (sum(relax_success) = 5)::INT AS all5_success,
    (sum(relax_success) >= 4)::INT AS atleast4_success, (sum(relax_success) >= 3)::INT AS atleast3_success
  FROM sample1 GROUP BY epoch, chain
)"""


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.epoch_chain_counts(sample1(spark, sf_dir))


def add_counts(name: str, run: Callable[[DataFrame], DataFrame], sql: str) -> None:
    add(name, lambda s, d: run(counts(s, d)))
    ORACLES[name] = f"WITH {SAMPLE}, {COUNTS}\n{sql}"


add_counts("epoch_chain_counts", lambda c: c, "SELECT * FROM counts")
add_counts(
    "threshold_flags",
    lambda c: selection.at_least(c, 5, exactly=True).select("epoch", "chain", F.lit("5").alias("slice")).union(selection.at_least(c, 4).select("epoch", "chain", F.lit(">=4"))).union(selection.at_least(c, 3).select("epoch", "chain", F.lit(">=3"))),
    """SELECT epoch, chain, '5' AS slice FROM counts WHERE success = 5 UNION ALL SELECT epoch, chain, '>=4' FROM counts WHERE success >= 4
UNION ALL SELECT epoch, chain, '>=3' FROM counts WHERE success >= 3""",
)
add_counts("pivot_matrix", lambda c: selection.pivot(c, "success", EPOCHS), "SELECT chain, " + ", ".join(f'max(success) FILTER (epoch = {e}) AS "{e}"' for e in EPOCHS) + " FROM counts GROUP BY chain")
add_counts("pivot_rates", lambda c: selection.pivot(c, "success_rate", EPOCHS), "SELECT chain, " + ", ".join(f'max(success_rate) FILTER (epoch = {e}) AS "{e}"' for e in EPOCHS) + " FROM counts GROUP BY chain")
PRIORITY = """SELECT chain, count(DISTINCT epoch) AS total_epochs, sum(success)::BIGINT AS total_success_runs, sum(error)::BIGINT AS total_error_runs,
  sum(all5_success)::BIGINT AS num_all5_epochs, sum(atleast4_success)::BIGINT AS num_atleast4_epochs, sum(atleast3_success)::BIGINT AS num_atleast3_epochs,
  round(avg(success), 6) AS mean_success_per_epoch FROM counts GROUP BY chain"""
add_counts("chain_priority", selection.chain_priority, PRIORITY)
add_counts(
    "topk_chains",
    lambda c: selection.chain_priority(c).limit(3),
    f"SELECT * FROM ({PRIORITY}) ORDER BY num_all5_epochs DESC, num_atleast4_epochs DESC, num_atleast3_epochs DESC, mean_success_per_epoch DESC, chain LIMIT 3",
)
add_counts(
    "first_all5",
    selection.first_full,
    "SELECT chain, min(epoch) AS first_epoch_all5, max(epoch) AS last_epoch_all5, count(*) AS num_all5_epochs FROM counts WHERE all5_success = 1 GROUP BY chain",
)
add(
    "sort_multi",
    lambda s, d: sample(s, d).select("epoch", "repeat", "chain", "event_id").orderBy("epoch", "repeat", "chain", "event_id"),
    "SELECT epoch, repeat, chain, event_id FROM sample ORDER BY ALL",
)


def _coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(spark, sf_dir).withColumn("measure", F.floor(F.col("mean_plddt") / 50) * 50).select("epoch", "repeat", "chain", "measure", "event_id")


BEST = """SELECT epoch, repeat, chain, (floor(mean_plddt / 50) * 50)::BIGINT AS measure, event_id FROM sample WHERE mean_plddt IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY epoch, chain ORDER BY floor(mean_plddt / 50) * 50 DESC, repeat, event_id) = 1"""
add("argmax_per_group", lambda s, d: selection.argmax_rows(_coarse(s, d), ["epoch", "chain"], "measure", [F.col("repeat"), F.col("event_id")]), BEST)
add(
    "first_mid_last",
    lambda s, d: selection.first_mid_last(
        selection.argmax_rows(_coarse(s, d), ["epoch", "chain"], "measure", [F.col("repeat"), F.col("event_id")]), ["chain"], ["epoch"]
    ),
    f"""SELECT * FROM ({BEST}) QUALIFY row_number() OVER (PARTITION BY chain ORDER BY epoch) - 1
  IN (0, count(*) OVER (PARTITION BY chain) // 2, count(*) OVER (PARTITION BY chain) - 1)""",
)
add(
    "dedup_first",
    lambda s, d: selection.first_rows(table(s, d, "documents").select("doc_id", "text", "lang"), ["text"], [F.col("doc_id")]).select("doc_id", "lang"),
    "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
)
add(
    "union_distinct",
    lambda s, d: table(s, d, "orders").select(F.col("o_custkey").alias("k")).union(table(s, d, "customer").select("c_custkey")).distinct(),
    "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer",
)

# Fixed-width records and logs


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each event: in the strict layout, of another model, or without one of the markers."""
    epoch, other = F.day("ts").cast("string"), F.col("event_id") % 9
    folder = F.when(other == 4, "misc").otherwise(F.concat(F.lit("epoch_"), epoch))
    name = F.concat(F.lit("c"), (F.col("user_id") % 7).cast("string"), F.when(other == 5, "_model_2").otherwise("_model_1"))
    state = F.when(F.col("event_id") % 2 == 0, "_unrelaxed.pdb").otherwise("_relaxed.pdb")
    repeat = F.when(other == 6, "again").otherwise(F.concat(F.lit("repeat_"), (F.col("event_id") % 5 + 1).cast("string")))
    model = F.concat(F.when(F.col("event_id") % 3 == 0, "your_model_epoch_").otherwise("trained_model_epoch_"), epoch)
    path = F.concat(F.concat_ws("/", F.lit("/r"), folder, model, repeat, F.lit("predictions"), name), state)
    return table(spark, sf_dir, "events").select("event_id", "event_type", path.alias("path"))


PATHS = """p AS (
  SELECT event_id, event_type, event_id % 9 AS other, day(ts)::INT AS epoch, (event_id % 5 + 1)::INT AS repeat, 'c' || (user_id % 7) AS c,
    CASE WHEN event_id % 2 = 0 THEN 'unrelaxed' ELSE 'relaxed' END AS state,
    '/r/' || CASE WHEN event_id % 9 = 4 THEN 'misc' ELSE 'epoch_' || day(ts) END
      || CASE WHEN event_id % 3 = 0 THEN '/your' ELSE '/trained' END || '_model_epoch_' || day(ts)
      || CASE WHEN event_id % 9 = 6 THEN '/again' ELSE '/repeat_' || (event_id % 5 + 1) END
      || '/predictions/c' || (user_id % 7) || CASE WHEN event_id % 9 = 5 THEN '_model_2' ELSE '_model_1' END AS stem
  FROM events
)"""


def _path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    strict, key = strict_key(path)
    loose, marks = loose_key(path)
    return _paths(spark, sf_dir).select(
        "event_id", strict.alias("strict"), F.when(strict, key["epoch"]).alias("s_epoch"), F.when(strict, key["repeat"]).alias("s_repeat"),
        F.when(strict, key["chain"]).alias("s_chain"), F.when(strict, key["state"]).alias("s_state"), loose.alias("loose"),
        F.when(loose, marks["epoch"]).alias("l_epoch"), F.when(loose, marks["repeat"]).alias("l_repeat"),
        chain_from_name(last_segment(path)).alias("chain"), relaxed_sibling(path).alias("sibling"),
    )


add(
    "path_keys",
    _path_keys,
    f"""WITH {PATHS}, k AS (SELECT *, other NOT IN (4, 5, 6) AS strict, other <> 6 AS loose FROM p)
SELECT event_id, strict, CASE WHEN strict THEN epoch END AS s_epoch, CASE WHEN strict THEN repeat END AS s_repeat, CASE WHEN strict THEN c END AS s_chain,
  CASE WHEN strict THEN state END AS s_state, loose, CASE WHEN loose THEN epoch END AS l_epoch, CASE WHEN loose THEN repeat END AS l_repeat,
  CASE WHEN state = 'relaxed' THEN c || CASE WHEN other = 5 THEN '_model_2' ELSE '_model_1' END || '_relaxed.pdb' WHEN other = 5 THEN c || '_model_2' ELSE c END AS chain,
  stem || '_relaxed.pdb' AS sibling FROM k""",
)


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a record of its file; every third is of another atom, some have no number."""
    number = F.when(F.col("event_id") % 13 == 0, "  ****").otherwise(F.format_string("%6.2f", (F.col("event_id") % 9973) / 100.0))
    kind = F.when(F.col("event_id") % 17 == 0, "HETATM").otherwise("ATOM  ")
    atom = F.when(F.col("event_id") % 3 == 0, " N  ").otherwise(" CA ")
    line = F.concat(kind, F.lpad((F.col("event_id") % 99999).cast("string"), 5, " "), F.lit(" "), atom, F.rpad(F.lit(" ALA A   1"), 44, " "), number, F.lit("           C"))
    return quality_of(ca_values(_paths(spark, sf_dir).select("path", line.alias("line"))))


add(
    "scan_fixed_width",
    _quality,
    f"""WITH {PATHS}
SELECT epoch, repeat, c AS chain, state, stem || '_' || state || '.pdb' AS pdb_path, round(avg((event_id % 9973) / 100.0), 6) AS mean_plddt,
  min((event_id % 9973) / 100.0) AS min_plddt, max((event_id % 9973) / 100.0) AS max_plddt, count(*) AS num_residues
FROM p WHERE other NOT IN (4, 5, 6) AND event_id % 3 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 GROUP BY ALL""",
)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are listed once for each event; those of errors have no relaxed counterpart."""
    paths = _paths(spark, sf_dir).where("event_id % 2 = 0")
    relaxed = paths.where("event_type != 'error'").select(relaxed_sibling(F.col("path")).alias("path"))
    return outcome_listing(paths, relaxed)


add(
    "outcome_listing",
    _listing,
    f"""WITH {PATHS}, u AS (SELECT stem, epoch, repeat, other, c, max((event_type <> 'error')::INT) AS ok FROM p WHERE event_id % 2 = 0 AND other NOT IN (4, 6) GROUP BY ALL
UNION ALL SELECT stem, epoch, repeat, other, c, max((event_type <> 'error')::INT) FROM p WHERE event_id % 2 = 0 AND other = 4 GROUP BY ALL
), d AS (SELECT stem, epoch, repeat, max(c || CASE WHEN other = 5 THEN '_model_2' ELSE '' END) AS chain, max(ok) AS ok FROM u GROUP BY stem, epoch, repeat)
SELECT epoch, repeat, chain, CASE ok WHEN 1 THEN 'success' ELSE 'error' END AS status, ok AS relax_success, 1 - ok AS relax_error,
  stem || '_unrelaxed.pdb' AS unrelaxed_path, stem || '_relaxed.pdb' AS relaxed_path, ok = 1 AS relaxed_exists FROM d""",
)


def _recommended(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    runs = sample1(spark, sf_dir).withColumn("mean_plddt", F.floor(F.col("mean_plddt") / 5) * 5.0)
    outcomes = runs.select(*KEYS, "relax_success", F.concat(F.lit("/u/"), F.col("event_id").cast("string")).alias("unrelaxed_path"))
    scores = runs.select(*KEYS, "mean_plddt", F.lit("unrelaxed").alias("state")).union(runs.select(*KEYS, F.lit(1e9), F.lit("relaxed")))
    return selection.recommend(outcomes, scores)[which]


RECOMMENDED = """best AS (
  SELECT chain, epoch, repeat, floor(mean_plddt / 5) * 5.0 AS mean_plddt, '' AS relaxed_path, '/u/' || event_id AS unrelaxed_path FROM sample1
  WHERE relax_success = 1 AND mean_plddt IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY epoch, chain ORDER BY floor(mean_plddt / 5) DESC, repeat) = 1
)"""
add("recommend_best", lambda s, d: _recommended(s, d, 0))
ORACLES["recommend_best"] = f"WITH {SAMPLE}, {RECOMMENDED} SELECT * FROM best"
add("recommend_some", lambda s, d: _recommended(s, d, 1))
ORACLES["recommend_some"] = f"""WITH {SAMPLE}, {RECOMMENDED} SELECT * FROM best
QUALIFY row_number() OVER (PARTITION BY chain ORDER BY epoch) - 1 IN (0, count(*) OVER (PARTITION BY chain) // 2, count(*) OVER (PARTITION BY chain) - 1)"""
add(
    "prepare_chains",
    lambda s, d: selection.prepare_chains(
        table(s, d, "customer").select(
            (F.col("c_custkey") % 3).cast("int").alias("model_id"), F.col("c_mktsegment").alias("pdb_id"),
            F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("A").alias("chain_id"), F.col("c_custkey").alias("chain_length"), F.col("c_name").alias("seq"), "c_nationkey",
        ),
        [F.col("chain_length")],
    ),
    """SELECT lower(c_mktsegment) || '_A' AS chain_key, c_mktsegment AS pdb_id, CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'A' END AS chain_id, 1 AS model_id,
  c_custkey AS chain_length, c_name AS seq FROM customer WHERE c_custkey % 3 = 1 QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) = 1""",
)


def _presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans = [planning.preset(spark, name, 2).select(F.lit(name).alias("preset"), "epoch", "repeat", "block") for name in planning.PRESETS]
    out = plans[0]
    for plan in plans[1:]:
        out = out.union(plan)
    return out


_RANGES = "('all', 0, 32), ('half1', 0, 14), ('half2', 15, 32), ('v4', 0, 7), ('v5', 8, 14), ('v6', 15, 20), ('v7', 21, 26), ('v8', 32, 32), ('v9', 5, 7), ('v10', 0, 7), ('v11', 15, 21), ('v12', 21, 26), ('v13', 27, 32)"
add(
    "run_plan_presets",
    _presets,
    f"""SELECT preset, epoch::INT AS epoch, repeat::INT AS repeat, {_CASE} AS block
FROM (VALUES {_RANGES}) p(preset, lo, hi) JOIN range(0, 33) e(epoch) ON epoch BETWEEN lo AND hi, range(1, 3) r(repeat)""",
)


def _log_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a line of one of eight logs; a view is a line of text, a signup a violations line."""
    path = F.concat(
        F.lit("/r/epoch_"), F.day("ts").cast("string"), F.lit("/m/repeat_"), (F.col("event_id") % 5 + 1).cast("string"),
        F.lit("/predictions/c"), (F.col("user_id") % 7).cast("string"), F.lit("_model_1_unrelaxed.pdb"),
    )
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", F.concat(F.lit("ERROR processing: "), path))
        .when(kind == "purchase", F.concat(F.lit("Saved: "), path))
        .when(kind == "click", F.concat(F.lit("[x] Relaxing: "), path))
        .when(kind == "signup", F.concat(F.lit("Violations: "), F.col("event_id").cast("string")))
        .otherwise(F.concat(F.lit("text "), F.col("event_id").cast("string")))
    )
    lines = table(spark, sf_dir, "events").select((F.col("user_id") % 8).alias("file"), F.col("event_id").alias("pos"), line.alias("line"))
    return logfold.fold(lines).drop("violations_raw")


add(
    "log_fold",
    _log_fold,
    """WITH e AS (
  SELECT user_id % 8 AS file, event_id AS pos, event_type AS kind, day(ts)::INT AS epoch, (event_id % 5 + 1)::INT AS repeat, 'c' || (user_id % 7) AS chain,
    '/r/epoch_' || day(ts) || '/m/repeat_' || (event_id % 5 + 1) || '/predictions/c' || (user_id % 7) || '_model_1_unrelaxed.pdb' AS path FROM events
), c AS (
  SELECT *, max(CASE WHEN kind IN ('error', 'purchase', 'click') THEN pos END) OVER (PARTITION BY file ORDER BY pos ROWS UNBOUNDED PRECEDING) AS at FROM e
), r AS (
  SELECT c.file, c.pos, c.kind, o.kind AS state, o.epoch, o.repeat, o.chain, o.path FROM c JOIN e o ON o.file = c.file AND o.pos = c.at
)
SELECT file, epoch, repeat, chain,
  CASE max_by(kind, pos) FILTER (kind IN ('error', 'purchase', 'click')) WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'success' ELSE 'running' END AS status,
  'text ' || min(pos) FILTER (kind = 'view' AND state = 'error') AS error_message,
  (max(pos) FILTER (kind = 'signup'))::DOUBLE AS violations,
  max_by(path, pos) FILTER (kind IN ('error', 'purchase', 'click')) AS source_path
FROM r GROUP BY file, epoch, repeat, chain""",
)

# Statistics

RANKS = """ranked AS (
  SELECT *, rank() OVER (ORDER BY epoch) + (count(*) OVER (PARTITION BY epoch) - 1) / 2.0 AS re,
    rank() OVER (ORDER BY mean_plddt) + (count(*) OVER (PARTITION BY mean_plddt) - 1) / 2.0 AS rq,
    rank() OVER (ORDER BY relax_error) + (count(*) OVER (PARTITION BY relax_error) - 1) / 2.0 AS rr
  FROM sample WHERE mean_plddt IS NOT NULL
)"""
add(
    "corr_pearson",
    lambda s, d: sample(s, d).agg(stats.safe_corr(F.col("epoch"), F.col("mean_plddt")).alias("epoch_quality"), stats.safe_corr(F.col("mean_plddt"), F.col("relax_error")).alias("quality_error")),
    "SELECT round(corr(epoch, mean_plddt), 6) AS epoch_quality, round(corr(mean_plddt, relax_error), 6) AS quality_error FROM sample",
)
add("corr_spearman", lambda s, d: stats.spearman(sample(s, d), "epoch", "mean_plddt"))
ORACLES["corr_spearman"] = f"WITH {SAMPLE}, {RANKS} SELECT round(corr(re, rq), 6) AS value FROM ranked"
add("correlation_summary", lambda s, d: stats.correlations(sample(s, d)))
ORACLES["correlation_summary"] = f"""WITH {SAMPLE}, {RANKS}
SELECT 'pearson_epoch_mean_plddt' AS metric, round(corr(epoch, mean_plddt), 6) AS value FROM ranked
UNION ALL SELECT 'pearson_mean_plddt_relax_error', round(corr(mean_plddt, relax_error), 6) FROM ranked
UNION ALL SELECT 'spearman_epoch_mean_plddt', round(corr(re, rq), 6) FROM ranked
UNION ALL SELECT 'spearman_mean_plddt_relax_error', round(corr(rq, rr), 6) FROM ranked"""
add("logistic_model", lambda s, d: stats.logistic(sample(s, d)).coefficients)


def _score_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, score): the mean of residual times term; all zero exactly at the coefficients of the largest likelihood."""
    rows = sample(spark, sf_dir).where("mean_plddt is not null")
    coef = {r["term"]: r["coef"] for r in stats.logistic(rows).coefficients.collect()}  # a dozen rows

    def value(term: str) -> Column:
        if term == "Intercept":
            return F.lit(1.0)
        if not term.startswith("C("):
            return F.col(term).cast("double")
        name, _, level = term[2:-1].partition(")[T.")
        return (F.col(name).cast("string") == level).cast("double")

    z = sum((F.lit(c) * value(t) for t, c in coef.items()), F.lit(0.0))
    rest = rows.select("*", (F.col("relax_error") - 1 / (1 + F.exp(-z))).alias("rest"))
    terms = [F.struct(F.lit(t).alias("term"), F.round(F.avg(F.col("rest") * value(t)), 6).alias("score")) for t in sorted(coef)]
    return rest.agg(F.array(*terms).alias("all")).select(F.inline("all")).select("term", (F.col("score") + 0.0).alias("score"))


add("logistic_score_equations", _score_equations)
ORACLES["logistic_score_equations"] = f"""WITH {SAMPLE}, s AS (SELECT * FROM sample WHERE mean_plddt IS NOT NULL)
SELECT unnest(['Intercept', 'mean_plddt', 'epoch']) AS term, 0.0::DOUBLE AS score
UNION ALL SELECT 'C(chain)[T.' || chain || ']', 0.0 FROM (SELECT DISTINCT chain FROM s) WHERE chain <> (SELECT min(chain) FROM s)
UNION ALL SELECT 'C(repeat)[T.' || repeat || ']', 0.0 FROM (SELECT DISTINCT repeat FROM s) WHERE repeat <> (SELECT min(repeat) FROM s)"""
