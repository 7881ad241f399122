"""URL filters over a sorted digest array.

Rules (a host and a path prefix, with a verdict) and a list of blocked hosts are kept as one sorted array of 64-bit xxhash
digests, with the full strings beside it, in one file image that executors memory-map.  A url asks for every
suffix of its host joined with every prefix of its path that is as long as some rule's path; the digests of the distinct questions are
probed by a vectorised binary search and confirmed against the stored strings, so a collision can't decide anything.
Of the rules that fit, the longest wins.  Where none fits, the blocked hosts decide, and else the url is allowed.

A list is a sequence or a table of any size.  It is cut by the upper bits of its digests, and an executor builds each part's image.
One image is shipped to the executors while it is small (``MOST_BYTES``, checked by its bytes).  A larger list stays in parts: the
distinct questions go to the part that their digest names and are probed there by the same search.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import materialise, only_row, others, plain

ALLOW, BLOCK = "allow", "block"
#: Fixed values.  (rule, verdict); a rule is a host and a path prefix, "com/": the first slash parts them.
RULES = (
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
)
#: Hosts, subdomains included, that are blocked where no rule fits.
BLOCKED_HOSTS = ("spam-farm.example.org",)
#: Size of a list whose image is shipped to executors at most, and about that of a part of a larger one.
MOST_BYTES, PART_BYTES = 128 << 20, 16 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


# Keys: kind, host and path.  Kind 0 is a rule, kind 1 a blocked host.


def _key(kind: int, host: str, path: str) -> bytes:
    return f"{kind}{host}\0{path}".encode()


def _signed(digest: int) -> int:
    return digest - (1 << 64) * (digest >> 63)


def listing(spark: SparkSession, rules: Sequence[tuple[str, str]] | DataFrame, blocked_hosts: Sequence[str] | DataFrame) -> DataFrame:
    """(kind, host, path, verdict) of all rules and hosts, each key once; of a rule's repeats a block stands.

    A table of rules has the columns rule and verdict, one of hosts the column host; null entries are left out.
    """
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(pd.DataFrame(list(rules), columns=["rule", "verdict"]), "rule string, verdict string")
    if not isinstance(blocked_hosts, DataFrame):
        blocked_hosts = spark.createDataFrame(pd.DataFrame({"host": list(blocked_hosts)}), "host string")
    parts = F.substring_index("rule", "/", 1)
    own = rules.where("rule is not null").select(
        F.lit(0).alias("kind"), F.translate(parts, _UPPER, _LOWER).alias("host"), F.substring("rule", F.length(parts) + 1, F.length("rule")).alias("path"), "verdict"
    )
    hosts = blocked_hosts.where("host is not null").select(F.lit(1).alias("kind"), F.translate("host", _UPPER, _LOWER).alias("host"), F.lit("").alias("path"), F.lit(BLOCK).alias("verdict"))
    fits = (F.coalesce(F.col("verdict"), F.lit("")).isin(ALLOW, BLOCK)) & (F.col("host") != "")
    checked = own.union(hosts).withColumn("verdict", F.when(fits, F.col("verdict")).otherwise(F.raise_error(F.concat(F.lit("no rule: "), F.col("host"), F.col("path")))))
    return checked.groupBy("kind", "host", "path").agg(F.max("verdict").alias("verdict"))  # "block" is after "allow"


class DigestArray:
    """A file image: counts, sorted digests, ends of the stored keys, verdicts, the path lengths in use, the keys."""

    @staticmethod
    def build(keys: list[bytes], blocks: Sequence[bool], lengths: Sequence[int]) -> bytes:
        digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype="<u8")
        order = np.argsort(digests, kind="stable")
        ends = np.cumsum([len(keys[i]) for i in order], dtype="<i8") if keys else np.zeros(0, "<i8")
        verdicts = np.asarray(blocks, dtype="<i8")[order] if keys else np.zeros(0, "<i8")
        head = np.array([len(keys), len(lengths)], dtype="<i8")
        parts = [head, digests[order], ends, verdicts, np.asarray(lengths, dtype="<i8")]
        return b"".join(p.tobytes() for p in parts) + b"".join(keys[i] for i in order)

    @classmethod
    def open(cls, path: str) -> DigestArray:
        """The image in a file, memory-mapped."""
        return cls(np.memmap(path, dtype=np.uint8, mode="r"))

    def __init__(self, raw: np.ndarray) -> None:
        n, m = raw[:16].view("<i8")
        cut = 16 + 8 * np.cumsum([n, n, n, m])
        self.digests = raw[16 : cut[0]].view("<u8")
        self.ends = raw[cut[0] : cut[1]].view("<i8")
        self.verdicts = raw[cut[1] : cut[2]].view("<i8")
        self.lengths = raw[cut[2] : cut[3]].view("<i8").tolist()
        self.keys = raw[cut[3] :]

    def find(self, asked: list[bytes]) -> np.ndarray:
        """For each key the index of its entry, or -1."""
        digests = np.array([xxhash.xxh64_intdigest(k) for k in asked], dtype="<u8")
        lo = np.searchsorted(self.digests, digests, "left")
        hi = np.searchsorted(self.digests, digests, "right")
        out = np.full(len(asked), -1, np.int64)
        for i in np.flatnonzero(hi > lo):
            for k in range(lo[i], hi[i]):  # more than one only where digests collide
                start = self.ends[k - 1] if k else 0
                if self.keys[start : self.ends[k]].tobytes() == asked[i]:
                    out[i] = k
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str]]:
        """(rule or None, verdict) for each host and path."""
        asked: dict[bytes, int] = {}
        wanted = [[(asked.setdefault(k, len(asked)), rule, size) for k, rule, size in questions(h, p, self.lengths)] for h, p in zip(hosts, paths, strict=True)]
        found = self.find(list(asked))
        out = []
        for own in wanted:
            hits = [(rule is not None, len(rule or ""), size, rule, int(found[k])) for k, rule, size in own if found[k] >= 0]
            best = max(hits, key=lambda x: x[:3], default=None)
            out.append((best[3], BLOCK if self.verdicts[best[4]] else ALLOW) if best else (None, ALLOW))
        return out


def questions(host: str, path: str, lengths: Sequence[int]) -> Iterator[tuple[bytes, str | None, int]]:
    """(key, rule or None, length of its host) of all entries that would fit the host and the path."""
    at = 0
    while True:
        part = host[at:]
        for n in lengths:
            if n <= len(path):
                yield _key(0, part, path[:n]), part + path[:n], len(part)
        yield _key(1, part, ""), None, len(part)
        at = host.find(".", at) + 1
        if not at:
            return


_opened: dict[str, DigestArray] = {}


def _open(name: str) -> DigestArray:
    if name not in _opened:
        _opened[name] = DigestArray.open(SparkFiles.get(name))
    return _opened[name]


def _ship(spark: SparkSession, image: bytes) -> str:
    """Give the image to every executor; Spark fetches it from the driver into each executor's own folder.  An image goes once."""
    name = f"digests-{hashlib.md5(image).hexdigest()}"
    if any(uri.rsplit("/", 1)[-1] == name for uri in spark.sparkContext.listFiles):
        return name
    path = os.path.join(tempfile.mkdtemp(), name)
    with open(path, "wb") as f:
        f.write(image)
    spark.sparkContext.addFile(path)
    return name


def _part(digest: Column, parts: int) -> Column:
    """The part of a list that a signed digest belongs to, by its upper bits."""
    return F.floor(F.shiftrightunsigned(digest, 33).cast("double") * parts / float(1 << 31)).cast("int")


def images(entries: DataFrame, lengths: Sequence[int], parts: int) -> DataFrame:
    """(part, image): the digest array of each part of the list."""

    def keyed(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            keys = [_key(k, h, p) for k, h, p in zip(pdf["kind"], pdf["host"], pdf["path"], strict=True)]
            yield pd.DataFrame({"digest": [_signed(xxhash.xxh64_intdigest(k)) for k in keys], "key": keys, "block": pdf["verdict"] == BLOCK})

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "image": [DigestArray.build(list(pdf["key"]), list(pdf["block"]), lengths)]})

    found = entries.mapInPandas(keyed, "digest long, key binary, block boolean")
    return found.select(_part(F.col("digest"), parts).alias("part"), "key", "block").groupBy("part").applyInPandas(build, "part int, image binary")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] | DataFrame = RULES,
    blocked_hosts: Sequence[str] | DataFrame = BLOCKED_HOSTS,
    url_col: str = "url",
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``pages`` with the columns host, path, rule and verdict; columns of those names, in any case, are replaced, others pass unchanged.

    A null url, or one without ``://``, has an empty host and path; no rule fits it and it is allowed.  A rule fits its host and
    all subdomains if the path starts with the rule's (a rule without a path fits every path).  The longest rule wins, of equally
    long ones that with the longer host.  Repeated rows are judged alike; an empty table gives an empty one.
    ``rules`` may be a table (rule, verdict) and ``blocked_hosts`` one of hosts, of any size; a rule of another verdict is an error.
    """
    spark, new = pages.sparkSession, ("host", "path", "rule", "verdict")
    rows, url = plain(pages, url_col)
    keep = others(pages.columns, new)
    own = [f"c{i}" for i in keep]
    host, path = host_and_path(F.col(url).cast("string"))
    rows = rows.select(*own, host.alias("host"), path.alias("path"))
    names = [*[pages.columns[i] for i in keep], *new]
    entries = materialise(listing(spark, rules, blocked_hosts), "entries")
    weight = F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 26), F.lit(0))
    seen = entries.agg(weight.alias("bytes"), F.array_sort(F.collect_set(F.when(F.col("kind") == 0, F.length("path")))).alias("lengths")).first()
    if seen["bytes"] > most_bytes:
        return _by_parts(rows, own, entries, seen["lengths"], max(1, -(-seen["bytes"] // PART_BYTES))).toDF(*names)
    found = only_row(images(entries, seen["lengths"], 1))  # MOST_BYTES at most
    name = _ship(spark, bytes(found["image"]) if found else DigestArray.build([], [], []))
    schema = T.StructType([*rows.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = _open(name)
        for batch in batches:
            pairs = pd.MultiIndex.from_arrays([batch.column(len(own)).to_pylist(), batch.column(len(own) + 1).to_pylist()])
            codes, distinct = pd.factorize(pairs)
            found = digests.judge([h for h, _ in distinct], [p for _, p in distinct])
            rule, verdict = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())
            at = pa.array(codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, rule.take(at), verdict.take(at)], names=[*own, *new])

    return rows.mapInArrow(run, schema).toDF(*names)


def _by_parts(rows: DataFrame, own: list[str], entries: DataFrame, lengths: Sequence[int], parts: int) -> DataFrame:
    """The same verdicts for a list that is too large to ship: each distinct question goes to the part of its digest."""
    pairs = rows.select("host", "path").distinct()

    def ask(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            out = [(h, p, _signed(xxhash.xxh64_intdigest(k)), k, rule, size) for h, p in zip(pdf["host"], pdf["path"], strict=True) for k, rule, size in questions(h, p, lengths)]
            yield pd.DataFrame(out, columns=["host", "path", "digest", "key", "rule", "size"])

    def probe(asked: pd.DataFrame, image: pd.DataFrame) -> pd.DataFrame:
        if image.empty or asked.empty:
            return pd.DataFrame(columns=["digest", "key", "verdict"])
        array = DigestArray(np.frombuffer(image["image"].iloc[0], np.uint8))
        found = array.find(list(asked["key"]))
        hit = np.flatnonzero(found >= 0)
        verdict = np.where(array.verdicts[found[hit]] == 1, BLOCK, ALLOW)
        return pd.DataFrame({"digest": asked["digest"].to_numpy()[hit], "key": asked["key"].to_numpy()[hit], "verdict": verdict})

    asked = materialise(pairs.mapInPandas(ask, "host string, path string, digest long, key binary, rule string, size int"), "questions")
    # More groups than parts where there are many questions, so that none holds more than a few hundred thousand.
    split = max(1, asked.count() // (parts * 200_000))
    salt = F.pmod(F.col("digest"), F.lit(split)).cast("int").alias("salt")
    distinct = asked.select("digest", "key").distinct().select(_part(F.col("digest"), parts).alias("part"), salt, "digest", "key")
    lists = images(entries, lengths, parts).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(split - 1))))
    hits = distinct.groupBy("part", "salt").cogroup(lists.groupBy("part", "salt")).applyInPandas(probe, "digest long, key binary, verdict string")
    best = F.max(F.struct(F.col("rule").isNotNull().alias("r"), F.coalesce(F.length("rule"), F.lit(0)).alias("n"), "size", "rule", "verdict"))
    judged = asked.join(hits, ["digest", "key"]).groupBy("host", "path").agg(best.alias("b"))
    out = rows.join(judged, ["host", "path"], "left")
    return out.select(*own, "host", "path", F.col("b.rule").alias("rule"), F.coalesce(F.col("b.verdict"), F.lit(ALLOW)).alias("verdict"))
