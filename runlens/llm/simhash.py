"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most 2r bits exactly if some value lies within r bits of both.  So every distinct
fingerprint emits all values within r bits of it (2,081 for r = 2), the values are shuffled, and fingerprints that meet in a
value are linked.

A variant's bucket is its 64 bits folded to ``bits`` parities, each over a group of bits of its own.  Folding is linear, so the bucket
of a fingerprint's variant is the fingerprint's own bucket combined with that of the flipped bits, and r flipped bits change r
parities at most.  So a fingerprint has variants in 1 + bits + bits (bits - 1) / 2 buckets (r = 2) out of 2 ** bits: it travels
once to each of these, eight bytes instead of its variants there, and is expanded there, part by part.  With more fingerprints
there are more bits: at 7 bits a bucket sees 29 / 128 of all, at 16 bits 137 / 65,536, so buckets stay small while copies grow slowly.

Fingerprints that meet in one value are all within 2r bits of one another, so a star from the first of them loses no
connection and no pair list is ever made; each of its links is verified by a bit count, and each bucket sends on a spanning
forest only.

Documents can be looked at in several ways (``View``): each has its own fingerprint, and documents are linked if any of them is near.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import discard, materialise, plain, release_shuffles
from .components import connected_components

MAX_BITS = 4
#: Fingerprints that travel together.
BLOCK = 16_384
#: Variants that are expanded at a time, fingerprints that a bucket holds on average at most, and bits of a bucket at least.
PART_VARIANTS, BUCKET_FINGERPRINTS = 2_000_000, 500_000
#: Variants for each task.
TASK_VARIANTS = 10_000_000
LEAST_BITS, MOST_BITS = 7, 28


@dataclass(frozen=True)
class View:
    """What is hashed: runs of ``words`` words, each as often as it occurs or (``distinct``) once; ``salt`` makes another view of the same."""

    words: int = 4
    seed: int = 42
    distinct: bool = False
    salt: int = 0


SHINGLES = View()
#: Shingles of four words, and five independent views of the set of words.  An edit changes few words but many shingles: with these a pair
#: whose five-word shingles have a Jaccard similarity of 0.8 or more is nearly always linked, directly or by others of its group.
NEAR_COPIES = (SHINGLES, *(View(1, 42, True, salt) for salt in (1, 2, 3, 4, 5)))


def _fold(h: np.ndarray) -> int:
    """The fingerprint of hashes: bits that more than half of them have."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[i : i + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def _salted(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def fingerprints_of(text: str | None, views: Sequence[View] = (SHINGLES,)) -> list[int]:
    """The text's 64-bit SimHash in each view; 0 if it has no words.  A text shorter than a shingle is one shingle."""
    words = text.encode().lower().split() if text else []  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return [0] * len(views)
    digest, hashed, out = xxhash.xxh64_intdigest, {}, []
    for view in views:
        key = view.words, view.seed, view.distinct
        if key not in hashed:
            size = min(view.words, len(words))
            n = len(words) - size + 1
            shingles = words if size == 1 else map(b" ".join, zip(*(words[i : n + i] for i in range(size)), strict=True))
            if view.distinct:
                shingles = dict.fromkeys(shingles)
                n = len(shingles)
            hashed[key] = np.fromiter((digest(s, view.seed) for s in shingles), dtype="<u8", count=n)
        out.append(_fold(_salted(hashed[key], view.salt) if view.salt else hashed[key]))
    return out


def fingerprint(text: str | None, view: View = SHINGLES) -> int:
    """The text's fingerprint in one view."""
    return fingerprints_of(text, (view,))[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", views: Sequence[View] = (SHINGLES,)) -> DataFrame:
    """(doc_id, fp0, fp1, ...): the fingerprints of every row's whole text, as signed longs."""
    rows, i, t = plain(docs, id_col, text_col)
    return _fingerprints(rows.select(F.col(i).cast("long").alias("doc_id"), F.col(t).cast("string").alias("text")), views)


def _fingerprints(rows: DataFrame, views: Sequence[View]) -> DataFrame:
    """``rows``, whose last column is the text and whose others are longs, with fingerprints in the text's stead."""
    kept = rows.columns[:-1]
    names = [*kept, *[f"fp{k}" for k in range(len(views))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([fingerprints_of(t.as_py(), views) for t in batch.column(len(kept))], dtype=np.uint64).reshape(-1, len(views)).view(np.int64)
            cols = [pa.array(np.ascontiguousarray(own[:, k]), pa.int64()) for k in range(len(views))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=names)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def flip_masks(radius: int) -> np.ndarray:
    """All 64-bit values with at most ``radius`` bits set."""
    own = [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(64), k)]
    return np.array(own, dtype=np.uint64)


#: The bits in a fixed order that has nothing to do with where they stand, and parities that part a bucket's work further.
_ORDER = np.random.default_rng(1).permutation(64)
_CHECKS = np.random.default_rng(2).integers(1, 1 << 64, 40, dtype=np.uint64)


def syndrome(values: np.ndarray, bits: int, more: int = 0) -> np.ndarray:
    """``bits`` parities of each value over groups of its bits that share none, then ``more`` of random bits.

    It is linear: that of a ^ b is that of a ^ that of b.
    """
    out = np.zeros(len(values), np.int64)
    for i in range(bits):
        group = np.uint64(sum(1 << int(b) for b in _ORDER[i::bits]))
        out |= (np.bitwise_count(values & group) & 1).astype(np.int64) << i
    for i in range(more):
        out |= (np.bitwise_count(values & _CHECKS[i]) & 1).astype(np.int64) << (bits + i)
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n nodes reaches over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _by_syndrome(values: np.ndarray, bits: int, more: int = 0) -> dict[int, np.ndarray]:
    """The places of the values with each syndrome."""
    s = syndrome(values, bits, more)
    order = np.argsort(s, kind="stable")
    found, at = np.unique(s[order], return_index=True)
    return dict(zip(found.tolist(), np.split(order, at[1:]), strict=True)) if len(values) else {}


def _meet(bucket: int, fps: np.ndarray, bits: int, masks: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (a, b) of the fingerprints that meet in the bucket's variants."""
    fps = np.unique(fps)
    more = 0
    while len(fps) * len(masks) >> bits + more > PART_VARIANTS:
        more += 1
    own = _by_syndrome(fps, bits, more)
    flips = _by_syndrome(masks, bits, more)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in range(1 << more):
        goal = bucket | part << bits
        variants, of = [], []
        for s, mine in own.items():
            f = flips.get(s ^ goal)
            if f is not None:
                variants.append((fps[mine][:, None] ^ masks[f][None, :]).ravel())
                of.append(np.repeat(mine, len(f)))
        if not variants:
            continue
        variant, of = np.concatenate(variants), np.concatenate(of)
        order = np.argsort(variant)
        variant, of = variant[order], of[order]
        again = np.zeros(len(variant), bool)
        again[1:] = variant[1:] == variant[:-1]
        starts = np.flatnonzero(~again)
        hit = np.flatnonzero(again)
        first = of[starts[np.searchsorted(starts, hit, side="right") - 1]]
        links = np.unique(first.astype(np.uint64) << np.uint64(32) | of[hit].astype(np.uint64))
        x, y = (links >> np.uint64(32)).astype(np.int64), (links & np.uint64(0xFFFFFFFF)).astype(np.int64)
        near = np.bitwise_count(fps[x] ^ fps[y]) <= max_bits
        a.append(x[near])
        b.append(y[near])
    root = _roots(len(fps), np.concatenate(a), np.concatenate(b))
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked].view(np.int64), fps[root[linked]].view(np.int64)


def near_links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints within ``max_bits`` bits of one another, directly or on.

    ``distinct`` has each fingerprint once, in column ``fp``; ``n`` is their number.
    """
    return _links_by_view(distinct.select(F.lit(0).alias("view"), "fp"), n, 1, max_bits).select("a", "b")


def _links_by_view(distinct: DataFrame, n: int, views: int, max_bits: int) -> DataFrame:
    """(view, a, b): what ``near_links`` tells of the fingerprints of each view; ``n`` is the number of (view, fp) in all ``views``.

    One plan for all views: a bucket is one of a view, and the driver's plans stay as small as for one.
    """
    if max_bits % 2:
        raise ValueError("the ball's radius is half of max_bits, which must be even")
    masks = flip_masks(max_bits // 2)
    bits = LEAST_BITS
    while bits < MOST_BITS and n * len(np.unique(syndrome(masks, bits))) // views >> bits > BUCKET_FINGERPRINTS:
        bits += 1

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reached = np.unique(syndrome(masks, bits))
        for pdf in batches:
            of, fps = pdf["view"].to_numpy(np.int32), pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for view in np.unique(of):
                own = fps[of == view]
                for i in range(0, len(own), BLOCK):
                    block = own[i : i + BLOCK]
                    goes = (syndrome(block, bits)[:, None] ^ reached[None, :]).ravel()
                    order = np.argsort(goes, kind="stable")
                    buckets, at = np.unique(goes[order], return_index=True)
                    parts = np.split(block[order // len(reached)], at[1:])
                    yield pd.DataFrame({"view": view, "bucket": buckets.astype(np.int32), "fps": [x.tobytes() for x in parts]})

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.concatenate([np.frombuffer(x, "<u8") for x in pdf["fps"]])
        a, b = _meet(int(pdf["bucket"].iloc[0]), fps, bits, masks, max_bits)
        return pd.DataFrame({"view": np.full(len(a), pdf["view"].iloc[0], np.int32), "a": a, "b": b})

    # By view, so that batches are of one view and blocks don't become small.
    blocks = distinct.select("view", "fp").repartition(max(1, -(-n // (BLOCK * views)))).sortWithinPartitions("view")
    variants = blocks.mapInPandas(emit, "view int, bucket int, fps binary")
    # A few bytes make very many variants, so tasks are counted by variants and not left to be merged by their bytes.
    variants = variants.repartition(max(1, min(views << bits, -(-n * len(masks) // TASK_VARIANTS))), "view", "bucket")
    return variants.groupBy("view", "bucket").applyInPandas(meet, "view int, a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, views: Sequence[View] = (SHINGLES,)
) -> DataFrame:
    """One row per input row: (doc_id, fp0, ..., component_id).

    Rows whose fingerprints differ in at most ``max_bits`` bits in any view are linked; component_id is the smallest doc_id reachable
    over links, the row's own included.  Null and empty texts, and texts of white space, have fingerprint 0 and are linked like any
    other.  Texts shorter than a shingle are one shingle.  Repeated rows each get a row.  A null doc_id is never a component's
    smallest while another is there; a component of null ids alone has a null component_id.  Other columns are ignored.  An empty
    table gives an empty one.
    """
    own = materialise(fingerprints(docs, id_col, text_col, views), "fingerprints")
    groups = _groups(own.groupBy(*_fps(views)).agg(F.min("doc_id").alias("least")), len(views), max_bits)
    return own.join(groups, _fps(views)).select("doc_id", *_fps(views), F.col("least").alias("component_id"))


def _fps(views: Sequence[View]) -> list[str]:
    return [f"fp{k}" for k in range(len(views))]


def _groups(combinations: DataFrame, views: int, max_bits: int) -> DataFrame:
    """(fp0, ..., least): each combination of fingerprints with the least ``least`` of its component; nulls count for nothing."""
    fps = [f"fp{k}" for k in range(views)]
    # One node for each combination of fingerprints: copies are one node from here on.
    nodes = materialise(combinations.select(*fps, "least", F.monotonically_increasing_id().alias("node")), "nodes")
    # All views in one plan: a part for each view made 31 exchanges of six views, all of which the driver plans and runs at a time.
    values = nodes.select("node", F.posexplode(F.array(*fps)).alias("view", "fp"))
    heads = materialise(values.groupBy("view", "fp").agg(F.min("node").alias("head")), "heads")
    links = _links_by_view(heads, heads.count(), views, max_bits)
    ends = [heads.select("view", F.col("fp").alias(e), F.col("head").alias(f"{e}_head")) for e in "ab"]
    edges = links.join(ends[0], ["view", "a"]).join(ends[1], ["view", "b"]).select(F.col("a_head").alias("a"), F.col("b_head").alias("b"))
    if views > 1:
        edges = edges.union(values.join(heads, ["view", "fp"]).where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")))
    found = connected_components(edges)
    joined = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Written down, so that the join is one of plain tables and a component of very many nodes can be split over tasks.
    smallest = materialise(joined.groupBy("component").agg(F.min("least").alias("least")), "smallest")
    groups = materialise(joined.drop("least").join(smallest, "component").select(*fps, "least"), "groups")
    discard(smallest, nodes, heads)
    return groups


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, views: Sequence[View] = NEAR_COPIES
) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, all columns kept.

    A row is told from others by its id and a 128-bit digest of its columns (the columns that Spark can hash: not maps).  In each group
    the row with the smallest id stays, of several texts under that id the one with the smallest digest.  So an id that stands for
    unlike texts loses none of them: they are in groups of their own.  Rows that agree in id and digest repeat one another and come
    once.  Rows with a null id all stay.  Null and empty texts are one group.  Reruns keep the same rows.  An empty table stays empty.

    Only ids, digests and fingerprints are shuffled for the decision; texts meet the list of rows to drop in one anti join, whose small side Spark
    broadcasts if it is below the session's threshold.
    """
    rows, i, t = plain(docs, id_col, text_col)
    own = [F.col(c) for c in rows.columns]
    hashed = [F.col(f.name) for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    rows = rows.select(*own, F.col(i).cast("long").alias("_id"), F.xxhash64(F.lit(1), *hashed).alias("_x"), F.xxhash64(F.lit(2), *hashed).alias("_y"))
    key, fps = ["_id", "_x", "_y"], _fps(views)
    read = rows.where("_id is not null").select(*key, F.col(t).cast("string").alias("text"))
    seen = materialise(_fingerprints(read, views).groupBy(*key, *fps).agg(F.count("*").alias("n")), "fingerprints")
    groups = _groups(seen.groupBy(*fps).agg(F.min(F.struct(*key)).alias("least")), len(views), max_bits)
    judged = seen.join(groups, fps).select(*key, "n", (F.struct(*key) == F.col("least")).alias("first"))
    gone = materialise(judged.where("not first").select(*key), "gone")
    again = materialise(judged.where("first and n > 1").select(*key), "repeated")
    release_shuffles(docs.sparkSession)
    kept = rows.join(gone, key, "left_anti")
    if not again.isEmpty():
        kept = kept.join(again, key, "left_anti").select(*rows.columns).union(rows.join(again, key, "left_semi").select(*rows.columns).dropDuplicates(key))
    discard(seen, groups)
    return kept.select(*own).toDF(*docs.columns)
