"""The corpus pipeline: from the documents to the sharded training mix.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor; all but the last return the columns of
``documents``, whatever their names: columns are taken by place, and names with dots or that differ in case only do no harm.  ``doc_id`` and ``text``
must be there, ``source`` for the mix.  An empty table stays empty in every stage.  A driver may write each stage's result as Parquet and hand
the reread table to the next; ``runlens.llm.clean_up`` deletes the working tables when the last result has been written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import decontam, mixing, quality, sharding, simhash
from runlens.llm._store import materialise, prepare, read_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects; it learns from the labelled rows that are not held out.

    A null or empty text scores what the bias says, so all of these stay or all go.  Repeated rows are judged alike and stay each.  Rows with a null id
    are judged like others.  Without any labels every score is a half, below the threshold, and all documents go.
    """
    prepare(spark)
    labels = read_table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality.held_out()))
    score = "_score"
    while any(c.lower() == score for c in docs.columns):
        score += "_"
    return quality.score(docs, model, score_col=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each SimHash group.

    Rows are told apart by id and content: of several texts under one id only those go that resemble a kept document.  Rows that are equal in id and
    content come once.  Null and empty texts are one group.  Rows with a null id stay.
    """
    prepare(spark)
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item.

    Null and empty texts contain none and stay; repeated rows stay or go alike.  Items without words, or with a null id, are in nothing.
    """
    prepare(spark)
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources asks for.

    A null source is a source of its own.  Null and empty texts have size 0 and are taken at their source's rate; a source without words gives no copies.
    Repeated rows count each; which of rows that tie in id and size is taken more often makes no difference.  Copies are rows like the first.
    """
    return mixing.mix(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add each document's slot and shard.

    Copies and repeated rows go to one shard, rows with a null id where the empty text goes.  Columns that are named slot or shard, in any case, are replaced.
    """
    return sharding.assign(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: A trained model and SimHash groups are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
