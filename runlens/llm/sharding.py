"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: an offset and a skip taken
from its name's digest.  Shards take turns, each claiming the first free slot of its order, until all slots are taken.
So slots are shared out evenly to within one, and a change of the shard list moves little else.  A row's slot is a
digest of its key modulo the table's size; the shard is then one lookup.

The table has ``size`` rows whatever the data: it is made once on the driver, enters the plan as a literal and is
broadcast.  Placement itself is a projection and a broadcast hash join, without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import others, plain

#: A prime; the table has this many rows, which bounds what is broadcast.
SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
#: Rows of a lookup table at most; a larger one is refused.
MOST = 5_000_000


def _digest(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> list[int]:
    """For each slot the index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if size > MOST or size < len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table's size must be a prime, at least the number of shards and at most MOST")
    at = [_digest(s, "offset") % size for s in shards]
    skip = [_digest(s, "skip") % (size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while free:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return table


def slot(key: Column, size: int = SIZE) -> Column:
    """The slot of a key: the first 15 hex digits of the MD5 of its text, modulo the size (a null key: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % size


def table_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """The lookup table as rows (slot, shard), from literals alone."""
    text = F.lit(",".join(map(str, lookup_table(shards, size))))
    rows = spark.range(1, numPartitions=1).select(F.posexplode(F.split(text, ",")).alias("slot", "shard"))
    return rows.select(F.col("slot").cast("long").alias("slot"), F.col("shard").cast("int").alias("shard"))


def assign(
    docs: DataFrame, key_col: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = SIZE, shard_col: str = "shard", slot_col: str = "slot"
) -> DataFrame:
    """``docs`` with each row's slot and shard number.

    Rows with equal keys, repeated rows among them, go to one shard; null keys go where the empty text goes.  Columns that
    are named like the two new ones, in any case, are replaced.  An empty table stays empty.
    """
    rows, key = plain(docs, key_col)
    keep = others(docs.columns, (shard_col, slot_col))
    own = [f"c{i}" for i in keep]
    rows = rows.select(*own, slot(F.col(key), size).alias("slot"))
    placed = rows.join(F.broadcast(table_frame(docs.sparkSession, shards, size)), "slot", "left")
    return placed.select(*own, "slot", "shard").toDF(*[docs.columns[i] for i in keep], slot_col, shard_col)
