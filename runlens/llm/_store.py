"""Working tables in the folder that driver and executors share.

The place is the session's ``spark.checkpoint.dir``, or the checkpoint folder that its context was given.  Only where
there is none and the master is a single local JVM, as in tests, a temporary folder takes its stead.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession

#: Bytes of an Arrow batch.
ARROW_BATCH = "16m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Tables that were made for an application and not discarded yet, and the batch size that its session had.
_made: dict[str, list[str]] = {}
_batches: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder's URI, without a trailing slash."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="runlens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    path = f"{shared_dir(spark)}/runlens-{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._runlens_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``materialise`` that no later step reads."""
    for table in tables:
        delete_path(table.sparkSession, table._runlens_path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store through the file system that Spark itself uses."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    made = _made.get(spark.sparkContext.applicationId, [])
    if path in made:
        made.remove(path)


def only_row(df: DataFrame) -> Row | None:
    """The row of a table that has one at most, read to its end: a worker that makes it isn't cut off."""
    rows = df.collect()
    return rows[0] if rows else None


def clean_up(spark: SparkSession) -> int:
    """Delete the working tables and token stores that operators of this application have left in the shared folder; how many there were.

    Results are plans over these tables, so call it when they have been written or read.  It also gives the session back the Arrow batch size
    that it had before ``prepare``.
    """
    made = list(_made.get(spark.sparkContext.applicationId, []))
    for path in made:
        delete_path(spark, path)
    before = _batches.pop(spark.sparkContext.applicationId, None)
    if before is not None:
        spark.conf.set(_BATCH, before)
    return len(made)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that have been written down: it does so when the driver collects garbage, and this asks it to.

    Twice, since the last execution is let go of only by the first time.
    """
    for _ in range(2):
        spark.sparkContext._jvm.java.lang.System.gc()


def prepare(spark: SparkSession) -> None:
    """What the registered queries ask of a session before they start Python workers.

    Arrow batches end at ``ARROW_BATCH`` where the session leaves them at Spark's default, so that texts and blobs take little
    memory at a time; and Spark brings this package to the workers, wherever the driver has it from, once for each application.
    """
    before = spark.conf.get(_BATCH)
    if before.removesuffix("b") == str(64 << 20):
        _batches.setdefault(spark.sparkContext.applicationId, before)
        spark.conf.set(_BATCH, ARROW_BATCH)
    sc = spark.sparkContext
    if any(uri.endswith("/runlens-package.zip") for uri in sc.listFiles):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "runlens-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    own = os.path.join(folder, name)
                    out.write(own, os.path.relpath(own, os.path.dirname(top)))
    sc.addPyFile(path)


def place(names: Sequence[str], wanted: str) -> int:
    """Where a column stands: the one of exactly that name, else the first that differs in case only."""
    if wanted in names:
        return list(names).index(wanted)
    for i, name in enumerate(names):
        if name.lower() == wanted.lower():
            return i
    raise ValueError(f"no column {wanted!r} among {list(names)!r}")


def plain(df: DataFrame, *wanted: str) -> tuple[DataFrame, ...]:
    """``df`` with its columns renamed by position to c0, c1, ..., and what each wanted column is now called.

    Names with dots or back-quotes, and names that differ in case only, can then do no harm.
    """
    at = [f"c{place(df.columns, w)}" for w in wanted]
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), *at


def others(names: Sequence[str], new: Sequence[str]) -> list[int]:
    """The places of the columns that aren't named like one of ``new``, in whatever case."""
    taken = {n.lower() for n in new}
    return [i for i, n in enumerate(names) if n.lower() not in taken]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
