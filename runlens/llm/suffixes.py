"""Exact repeated-passage removal by a common-prefix-aware distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id.

Which suffixes are sorted: every window of ``length`` bytes has an anchor, the place inside it where a hash of the next
``ANCHOR`` bytes is least.  Equal windows have their anchors at the same offset, so it is enough to sort the suffixes that start
at anchors, one in some 14 of all, each cut where its last window ends and carrying the bytes of its windows before it.
As in distributed string sorting by distinguishing prefixes, a first exchange of hashes alone finds
the suffixes whose first bytes occur in one document only; they can be in no match and are not sent at all.

1. The texts are packed into segments, rows of some megabytes, in a table of the shared folder: a segment is the unit
   of all later work and is always the same bytes, whoever recomputes it.
2. Each segment sends the hashes of its anchors, sorted, to buckets by hash; a bucket answers which occur in several documents, and a
   sample of the anchors themselves gives the splitters, strings of ``ANCHOR`` bytes that cut the sorted order into ranges.
3. Each segment sorts the suffixes at those anchors, drops repeats (keeping the least document id), cuts the run at the splitters and sends each
   range a front-coded run: for each suffix the length of the prefix it shares with the one before, and the rest.
4. A range merges its runs with a loser tree that keeps, for every run's head, the length of the prefix it shares with the last
   winner; heads are compared by those lengths, and by bytes only beyond them.  The merged order comes with its own common
   prefix lengths, and these alone tell which windows are equal: a window that starts i bytes before its anchor reaches ``LENGTH`` - i bytes
   beyond it, so two are equal where the prefix lengths between their suffixes never fall below that, and those between the bytes before
   the anchors (sorted backwards from it, as suffixes in front of sampled ones are) never below i.  Each class of equal
   windows gets its least document id, in array operations over the whole range: no class is gathered by itself.
5. Each segment marks the windows whose least id is smaller than their document's, and cuts the texts.

An anchor with very many occurrences (``HOT``) isn't left to one range: its windows are parted into those that reach far beyond it and those that start
far before it, and each half is dealt by more bytes, the ones that all its windows have in common.

Runs are free of repeats before they travel, so a passage that thousands of documents share is one suffix per segment.
Answers go to segments, not to documents; nothing is gathered in one place.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import discard, materialise, only_row, plain, release_shuffles

LENGTH = 50
ANCHOR = 24
#: Bytes of text in a segment (one document at least).
SEGMENT_BYTES = 6 << 20
#: Bytes of text for each bucket of an exchange.
BUCKET_BYTES = 6 << 20
#: Ranges of the sorted order at most (their splitters are broadcast, ``ANCHOR`` bytes each), and anchors in a sample for each range.
MOST_RANGES, RANGE_SAMPLE = 1 << 18, 64
#: Occurrences of an anchor in a segment from which they are reported, and in all from which its windows are parted.
HEAVY, HOT = 16, 8192
NO_ID = np.iinfo(np.int64).max
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIXERS = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


# -- segments ---------------------------------------------------------------------------------------------------------


def segments(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(segment, ids, nulls, ends, text): packed rows of documents, in the shared folder.  A null id stands as the largest, with a flag."""
    docs, i, t = plain(docs, id_col, text_col)
    rows = docs.select(F.spark_partition_id().alias("p"), F.col(i).cast("long").alias("doc_id"), F.col(t).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[bytes] = []
        held, k, p = 0, 0, 0

        def out() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            cols = [
                pa.array([p << 33 | k], pa.int64()),
                pa.array([np.array([NO_ID if i is None else i for i in ids], np.int64).tobytes()], pa.binary()),
                pa.array([np.packbits([i is None for i in ids]).tobytes()], pa.binary()),
                pa.array([ends.tobytes()], pa.binary()),
                pa.array([_pack(b"".join(texts))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(cols, names=["segment", "ids", "nulls", "ends", "text"])

        for batch in batches:
            for part, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                p = part
                ids.append(doc)
                texts.append(text or b"")
                held += len(texts[-1])
                if held >= SEGMENT_BYTES:
                    yield out()
                    ids, texts, held, k = [], [], 0, k + 1
        if ids:
            yield out()

    packed = rows.mapInArrow(run, "segment long, ids binary, nulls binary, ends binary, text binary")
    return materialise(packed, "segments", compression="uncompressed", **{"parquet.block.size": str(16 << 20)})


class Segment:
    """A segment's bytes and anchors."""

    def __init__(self, ids: bytes, ends: bytes, text: bytes, length: int, anchor: int) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.ends = np.frombuffer(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.data = _unpack(text)
        self.length, self.anchor = length, anchor
        found = [self._anchors(i) for i in self._blocks()]
        none = np.zeros(0, np.int64)
        #: For each anchor: its hash, its place, its document, and its first and last window.
        self.hash = np.concatenate([f[0] for f in found] or [none.view(np.uint64)])
        self.at, self.doc, self.first, self.last = (np.concatenate([f[k] for f in found] or [none]) for k in (1, 2, 3, 4))

    def _blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of documents, about a quarter of a megabyte each: the arrays then stay in cache."""
        lo = 0
        while lo < len(self.ids):
            hi = max(lo + 1, int(np.searchsorted(self.ends, self.starts[lo] + (1 << 18))))
            yield lo, hi
            lo = hi

    def _anchors(self, block: tuple[int, int]) -> tuple[np.ndarray, ...]:
        lo, hi = block
        base, n = int(self.starts[lo]), int(self.ends[hi - 1] - self.starts[lo])
        k, span = self.anchor, self.length - self.anchor + 1
        if n < self.length:
            return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4
        raw = np.frombuffer(self.data, np.uint8, n, base)
        words = np.empty(n - 7, np.uint64)
        for shift in range(8):
            own = raw[shift : shift + (n - shift) // 8 * 8].view("<u8")
            words[shift::8] = own[: len(words[shift::8])]
        m = n - k + 1
        h = words[:m] * _M1
        part = np.empty_like(h)
        for i, off in enumerate([*range(8, k - 8, 8), k - 8]):
            np.multiply(words[off : off + m], _MIXERS[i % len(_MIXERS)], out=part)
            h += part
        np.right_shift(h, np.uint64(29), out=part)
        h ^= part
        h *= _M2
        # The upper half of a hash and the place make one number, so the least of a window is its first least hash's place.
        least = np.bitwise_and(h, np.uint64(0xFFFFFFFF00000000), out=part)
        least |= np.arange(m, dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if span > width:
            rest = span - width
            least = np.minimum(least[: len(least) - rest], least[rest:])
        at = least.astype(np.uint32)
        new = np.empty(len(at), bool)
        new[0] = True
        np.not_equal(at[1:], at[:-1], out=new[1:])
        starts, ends = self.starts[lo:hi] - base, self.ends[lo:hi] - base
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            stop = max(a, b - self.length + 1)  # windows from here on reach into the next document
            new[stop:b] = False
            if a < stop:
                new[a] = True
        first = np.flatnonzero(new)
        doc = np.searchsorted(ends, first, side="right")
        last = np.minimum(np.append(first[1:], len(at)) - 1, ends[doc] - self.length)
        at = at[first].astype(np.int64)
        return h[at], at + base, doc + lo, first + base, last + base


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h * _M1) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


# -- the first exchange: which anchors occur in several documents ---------------------------------------------------------


class _Hashes:
    """A segment's distinct anchor hashes, by bucket and in order, and the way back to its anchors."""

    def __init__(self, seg: Segment, buckets: int) -> None:
        self.seg = seg
        self.order = np.argsort(seg.hash, kind="stable")
        h = seg.hash[self.order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(new)
        self.counts = np.diff(np.append(at, len(h)))
        self.hash, self.place = h[at], seg.at[self.order[at]]
        d = seg.ids[seg.doc[self.order]]
        self.several = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at) if len(at) else np.zeros(0, bool)
        self.run_of = np.repeat(np.arange(len(at)), self.counts)
        where = _bucket(self.hash, buckets).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        self.by_bucket = np.argsort(where, kind="stable")
        self.cuts = np.searchsorted(where[self.by_bucket], np.arange(buckets + 1))

    def runs(self, every: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """(bucket, hashes, whether each is in several of the segment's documents, frequent ones, sampled ones).

        Of a hash that occurs ``HEAVY`` times or more its place in the run and its count are told.  Of the occurrences one in ``every`` is sampled,
        chosen by a hash of the anchors around it and so alike in all copies of a text: its hash's place and its anchor's bytes are told.
        """
        data, k = self.seg.data, self.seg.anchor
        h = self.seg.hash
        around = (h * _MIXERS[0] + np.append(h[1:], np.uint64(0)) * _MIXERS[1] + np.append(np.uint64(0), h[:-1]) * _MIXERS[2]) if len(h) else h
        around = (around ^ around >> np.uint64(31)) * _M2 >> np.uint64(24)
        of = np.empty(len(h), np.int64)
        of[self.order] = self.run_of
        picked = np.flatnonzero(around % np.uint64(every) == 0)
        picked = picked[np.unique(around[picked], return_index=True)[1]]
        sampled = np.sort(of[picked])
        for b in range(len(self.cuts) - 1):
            own = self.by_bucket[self.cuts[b] : self.cuts[b + 1]]
            if len(own):
                h = self.hash[own]
                heavy = np.flatnonzero(self.counts[own] >= HEAVY)
                times = np.searchsorted(sampled, own, side="right") - np.searchsorted(sampled, own)
                some = np.repeat(np.arange(len(own)), times)
                keys = b"".join(data[p : p + k] for p in self.place[own[some]].tolist())
                told = np.stack([heavy, self.counts[own[heavy]]]).astype("<u4").tobytes()
                yield b, _pack(h.tobytes()), np.packbits(self.several[own]).tobytes(), told, some.astype("<u4").tobytes() + keys

    def wanted(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Which anchors of the segment occur in several documents of the table, and which of them very often."""
        found = np.zeros((2, len(self.hash)), bool)
        for b in range(len(self.cuts) - 1):
            own = self.by_bucket[self.cuts[b] : self.cuts[b + 1]]
            if len(own):
                bits = np.unpackbits(np.frombuffer(answers[b], np.uint8))
                found[0, own] = bits[: len(own)]
                if len(bits) > -(-len(own) // 8) * 8:
                    found[1, own] = bits[-(-len(own) // 8) * 8 :][: len(own)]
        out = np.zeros((2, len(self.order)), bool)
        out[:, self.order] = np.repeat(found, self.counts, axis=1)
        return out[0], out[1]


def _answer_hashes(pdf: pd.DataFrame, anchor: int) -> pd.DataFrame:
    """A bit for each hash of each run: is it in several documents; where any is frequent, as many bits again for that.

    One more row, of no segment, has the sampled anchors that are in several documents and not frequent.
    """
    runs = [np.frombuffer(_unpack(x), "<u8") for x in pdf["hashes"]]
    flags = [np.unpackbits(np.frombuffer(x, np.uint8))[: len(r)].astype(bool) for x, r in zip(pdf["several"], runs, strict=True)]
    every = np.sort(np.concatenate(runs))
    shared = np.union1d(every[1:][every[1:] == every[:-1]], np.concatenate([r[f] for r, f in zip(runs, flags, strict=True)]))
    told = [np.frombuffer(x, "<u4").reshape(2, -1) for x in pdf["heavy"]]
    often, of = np.unique(np.concatenate([r[t[0]] for r, t in zip(runs, told, strict=True)]), return_inverse=True)
    hot = often[np.bincount(of, weights=np.concatenate([t[1] for t in told]), minlength=len(often)) >= HOT]
    own, sample = [], []

    def among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, h)
        return known[np.minimum(at, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)

    for r, blob in zip(runs, pdf["sample"], strict=True):
        bits = np.packbits(among(r, shared)).tobytes()
        frequent = among(r, hot)
        own.append(bits + np.packbits(frequent).tobytes() if frequent.any() else bits)
        n = len(blob) // (4 + anchor)
        h = r[np.frombuffer(blob, "<u4", n)]
        sample += [blob[4 * n + anchor * k :][:anchor] for k in np.flatnonzero(among(h, shared) & ~among(h, hot)).tolist()]
    out = pd.DataFrame({"segment": pdf["segment"], "bucket": pdf["bucket"], "bits": own})
    return pd.concat([out, pd.DataFrame({"segment": [-1], "bucket": out["bucket"].iloc[:1].to_numpy(), "bits": [b"".join(sample)]})])


def choose_splitters(sample: bytes, anchor: int, ranges: int) -> bytes:
    """Strings of ``anchor`` bytes, in order, that cut the sampled ones into at most ``ranges`` like parts."""
    keys = np.sort(np.frombuffer(sample, f"S{anchor}"))
    at = np.unique(np.arange(1, ranges) * len(keys) // ranges)
    return np.unique(keys[at[at > 0]]).tobytes() if len(keys) else b""


# -- the second exchange: front-coded runs of suffixes --------------------------------------------------------------------


def _deal(seg: Segment, rows: np.ndarray, hot: np.ndarray, splitters: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """(first window, anchor, last window, document, bucket) of the suffixes at some anchors, in order of their first windows.

    Equal windows always come to one bucket.  A suffix goes to the range of its anchor's bytes.  That at a frequent anchor is parted in two: windows that start
    at most ``half`` bytes before the anchor all reach length - half bytes beyond it, the others all start half + 1 bytes before it, and
    each part goes by a hash of what its windows have in common.
    """
    data, k, length = seg.data, seg.anchor, seg.length
    half = (length - k) // 2
    first, at, last, doc, hot = seg.first[rows], seg.at[rows], seg.last[rows], seg.doc[rows], hot[rows]
    raw = np.frombuffer(data, np.uint8)
    keys = np.lib.stride_tricks.sliding_window_view(raw, k)[at[~hot]] if (~hot).any() else np.zeros((0, k), np.uint8)
    where = np.zeros(len(rows), np.int64)
    where[~hot] = np.searchsorted(splitters, np.ascontiguousarray(keys).view(f"S{k}").ravel(), side="right")
    if not hot.any():
        return first, at, last, doc, where
    parts = [(first[~hot], at[~hot], last[~hot], doc[~hot], where[~hot])]
    f, a, z, d = first[hot], at[hot], last[hot], doc[hot]
    near = z >= a - half  # has windows that start at most ``half`` before the anchor
    by = [xxhash.xxh64_intdigest(data[x : x + length - half]) % buckets for x in a[near].tolist()]
    parts.append((np.maximum(f[near], a[near] - half), a[near], z[near], d[near], np.array(by, np.int64)))
    far = f < a - half
    by = [xxhash.xxh64_intdigest(data[x - half - 1 : x + k], 1) % buckets for x in a[far].tolist()]
    parts.append((f[far], a[far], np.minimum(z[far], a[far] - half - 1), d[far], np.array(by, np.int64)))
    joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.argsort(joined[0], kind="stable")
    return tuple(x[order] for x in joined)


def suffix_runs(
    seg: Segment, wanted: np.ndarray, hot: np.ndarray, splitters: np.ndarray, buckets: int
) -> tuple[dict[int, tuple[list[tuple[bytes, int, int]], list[int]]], bytes]:
    """For each bucket the distinct suffixes in order and the least document id of each; and notes for step 5.

    A suffix is (key, right, left): right bytes from the anchor on, then the left bytes before it.  Notes tell, for each
    suffix, its first window, how many windows it has, its bucket and its number there.
    """
    data = seg.data
    first, at, last, doc, where = _deal(seg, np.flatnonzero(wanted), hot, splitters, buckets)
    stop = last + seg.length
    found: dict[tuple[int, bytes, int, int], int] = {}
    number = found.setdefault
    of = [
        number((b, data[a:z] + data[f:a], z - a, a - f), len(found))
        for b, f, a, z in zip(where.tolist(), first.tolist(), at.tolist(), stop.tolist(), strict=True)
    ]
    of = np.array(of, np.int64)
    least = np.full(len(found), NO_ID, np.int64)
    np.minimum.at(least, of, seg.ids[doc])
    keys = list(found)
    order = sorted(range(len(keys)), key=keys.__getitem__)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    ids = least[order].tolist() if order else []
    runs: dict[int, tuple[list[tuple[bytes, int, int]], list[int]]] = {}
    base = {}
    for i, k in enumerate(order):
        b, *key = keys[k]
        if b not in runs:
            runs[b], base[b] = ([], []), i
        runs[b][0].append(tuple(key))
        runs[b][1].append(ids[i])
    starts = np.zeros(buckets, np.int64)
    for b, i in base.items():
        starts[b] = i
    steps = np.diff(first, prepend=0).astype("<u4").tobytes()
    windows = (last - first + 1).astype(np.uint8).tobytes()
    notes = steps + windows + where.astype("<u4").tobytes() + (rank[of] - starts[where]).astype("<u4").tobytes()
    return runs, _pack(notes)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the prefix that a and b share, of which ``known`` bytes are known to be equal."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    lo = known
    while True:  # by words, then within the word that differs
        x, y = a[lo : lo + 8], b[lo : lo + 8]
        if x != y:
            break
        lo += 8
    for i in range(8):
        if x[i : i + 1] != y[i : i + 1]:
            return lo + i
    return lo


def front_code(keys: list[tuple[bytes, int, int]], ids: list[int]) -> bytes:
    """A run: for each suffix the prefix shared with the one before, the two lengths, the other bytes, and the id."""
    shared, rest, last = bytearray(), [], b""
    for key, _, _ in keys:
        n = common_prefix(last, key)
        shared.append(n)
        rest.append(key[n:])
        last = key
    head = np.array([len(keys)], "<u4").tobytes() + bytes(shared)
    head += bytes(k[1] for k in keys) + bytes(k[2] for k in keys) + np.array(ids, "<i8").tobytes()
    return _pack(head + b"".join(rest))


def decode_run(blob: bytes) -> Iterator[tuple[int, bytes, int, int, int]]:
    """(shared prefix, key, right, left, id) of a run's suffixes, in order."""
    raw = _unpack(blob)
    n = int.from_bytes(raw[:4], "little")
    shared, right, left = raw[4 : 4 + n], raw[4 + n : 4 + 2 * n], raw[4 + 2 * n : 4 + 3 * n]
    ids = np.frombuffer(raw, "<i8", n, 4 + 3 * n).tolist()
    at, key = 4 + 11 * n, b""
    for s, r, le, doc in zip(shared, right, left, ids, strict=True):
        more = r + le - s
        key = key[:s] + raw[at : at + more]
        at += more
        yield s, key, r, le, doc


class LoserTree:
    """Merges sorted runs of (shared prefix, key, right, left, id).

    Every head keeps the length of the prefix it shares with the last key that was given out.  Of two heads the one that shares more is
    smaller; if they share equally much, bytes are compared from there on, and the loser then knows how much it shares with the
    winner.  When the loser's rival is given out, that length is again the one with the last key given out.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes, int, int, int]]]) -> None:
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads: list = [next(r, None) for r in runs]
        self.shared = [0] * self.k
        self.losers = [-1] * self.k

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        n, m = self.shared[a], self.shared[b]
        if n != m:
            return (a, b) if n > m else (b, a)
        n = common_prefix(x[1], y[1], n)
        if (x[1][n : n + 1], x[2], x[3], a) <= (y[1][n : n + 1], y[2], y[3], b):
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[int, int, tuple[int, bytes, int, int, int]]]:
        """(run, prefix shared with the key given out before, suffix), smallest first."""
        if not self.runs:
            return
        heads, shared, losers, k, play = self.heads, self.shared, self.losers, self.k, self._play
        winner = self._build(1) if k > 1 else 0
        while heads[winner] is not None:
            yield winner, shared[winner], heads[winner]
            heads[winner] = head = next(self.runs[winner], None)
            if head is not None:
                shared[winner] = head[0]  # the run's own front coding: its last key is the key just given out
            node = (winner + k) >> 1
            while node:
                rival = losers[node]
                if heads[rival] is not None and heads[winner] is not None and shared[rival] != shared[winner]:
                    if shared[rival] > shared[winner]:
                        losers[node], winner = winner, rival
                else:
                    winner, losers[node] = play(winner, rival)
                node >>= 1


def least_ids(shared: np.ndarray, right: np.ndarray, before: np.ndarray, left: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """The least id of each window of suffixes in sorted order; the column i is for windows that start i bytes before the anchor.

    ``shared`` is the prefix length that each suffix shares with the one before it, ``before`` the bytes in front of the anchors, nearest first, filled up with
    zeros.  Windows are equal where the shared lengths show it, to the right and to the left; cells without a window mean nothing.
    """
    n, span = before.shape
    words = np.ascontiguousarray(np.pad(before, ((0, 0), (0, -span % 8)))).view(">u8")
    back = np.lexsort(words[:, ::-1].T) if span else np.arange(n)
    ordered = before[back]
    differ = ordered[1:] != ordered[:-1]
    behind = np.zeros(n, np.int64)  # the length that each shares with the one before it in the order of the bytes in front
    behind[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), span) if span else 0
    out = np.full((n, span + 1), NO_ID)
    place = np.empty(n, np.int64)
    for i in range(span + 1):
        rows = np.flatnonzero((left >= i) & (right >= length - i))
        if not len(rows):
            continue
        ahead = np.cumsum(shared < length - i)[rows]
        place[back] = np.cumsum(behind < i)
        group = ahead * (n + 1) + place[rows]
        order = np.argsort(group, kind="stable")
        group = group[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        low = np.minimum.reduceat(ids[rows[order]], starts)
        out[rows[order], i] = np.repeat(low, np.diff(np.append(starts, len(rows))))
    return out


def _answer_runs(pdf: pd.DataFrame, length: int, anchor: int) -> pd.DataFrame:
    """Merge a bucket's runs; for each suffix of each run, in order, the least ids of its windows.  Notes pass as they are."""
    notes = pdf[pdf["bucket"] < 0]
    pdf = pdf[pdf["bucket"] >= 0]
    span = length - anchor
    runs, shared, right, left, ids, before = array("q"), bytearray(), bytearray(), bytearray(), array("q"), bytearray()
    for run, common, (_, key, r, le, doc) in LoserTree([decode_run(x) for x in pdf["run"]]):
        runs.append(run)
        shared.append(common)
        right.append(r)
        left.append(le)
        ids.append(doc)
        before += key[: r - 1 : -1].ljust(span, b"\0")
    n = len(runs)
    right, left = (np.frombuffer(x, np.uint8).astype(np.int16) for x in (right, left))
    run = np.frombuffer(runs, np.int64) if n else np.zeros(0, np.int64)
    least = least_ids(np.frombuffer(shared, np.uint8), right, np.frombuffer(before, np.uint8).reshape(n, span), left, np.frombuffer(ids, np.int64) if n else np.zeros(0, np.int64), length)
    least = least[:, ::-1]  # windows in the order of the text
    column = span - np.arange(span + 1, dtype=np.int16)
    there = (column <= left[:, None]) & (column >= length - right[:, None])
    low = np.where(there, least, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    one = low == np.where(there, least, np.iinfo(np.int64).min).max(axis=1, initial=np.iinfo(np.int64).min)
    counts = np.where(one, 1, there.sum(axis=1)).astype(np.uint8)
    there[one] = False
    there[np.flatnonzero(one), span - left[one]] = True  # one number is enough
    order = np.argsort(run, kind="stable")
    cuts = np.searchsorted(run[order], np.arange(len(pdf) + 1))
    own = []
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        rows = order[a:z]
        own.append(_pack((z - a).to_bytes(4, "little") + counts[rows].tobytes() + least[rows][there[rows]].astype("<i8").tobytes()))
    out = pd.DataFrame({"segment": pdf["segment"], "bucket": pdf["bucket"], "least": own})
    return pd.concat([out, notes[["segment", "bucket", "run"]].rename(columns={"run": "least"})])


# -- cutting --------------------------------------------------------------------------------------------------------------


def _covered(ids: np.ndarray, ends: np.ndarray, length: int, notes: bytes, answers: dict[int, bytes]) -> np.ndarray:
    """Which bytes of a segment (its documents' ids and ends) a removed window covers."""
    raw = _unpack(notes)
    n = len(raw) // 13
    first = np.cumsum(np.frombuffer(raw, "<u4", n).astype(np.int64))
    windows = np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.int64)
    where = np.frombuffer(raw, "<u4", n, 5 * n)
    rank = np.frombuffer(raw, "<u4", n, 9 * n).astype(np.int64)
    own = ids[np.searchsorted(ends, first, side="right")]
    edge = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
    order = np.argsort(where, kind="stable")
    cuts = np.searchsorted(where[order], np.arange(max(answers, default=-1) + 2))
    for b, blob in answers.items():
        rows = order[cuts[b] : cuts[b + 1]]
        raw = _unpack(blob)
        n = int.from_bytes(raw[:4], "little")
        counts = np.frombuffer(raw, np.uint8, n, 4).astype(np.int64)
        least = np.frombuffer(raw, "<i8", -1, 4 + n) if n else np.zeros(0, np.int64)
        stop = np.cumsum(counts)
        r = rank[rows]
        one = counts[r] == 1
        gone = rows[one][least[stop[r[one]] - 1] < own[rows[one]]]
        np.add.at(edge, first[gone], 1)
        np.add.at(edge, first[gone] + windows[gone] - 1 + length, -1)
        rows, r = rows[~one], r[~one]
        if len(rows):
            each = counts[r]
            step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            low = least[np.repeat(stop[r] - each, each) + step]
            start = (np.repeat(first[rows], each) + step)[low < np.repeat(own[rows], each)]
            np.add.at(edge, start, 1)
            np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(ids: np.ndarray, nulls: np.ndarray, ends: np.ndarray, data: bytes, covered: np.ndarray, texts: bool) -> pd.DataFrame:
    out = []
    raw = np.frombuffer(data, np.uint8)
    for doc, null, lo, hi in zip(ids.tolist(), nulls.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        gone = covered[lo:hi]
        n = int(gone.sum())
        if n:
            flips = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).view(np.int8)))
            starts, stops = flips[::2], flips[1::2]
            kept = raw[lo:hi][~gone].tobytes()
        else:
            starts = stops = np.zeros(0, np.int64)
            kept = data[lo:hi]
        row = (None if null else doc, hi - lo, n, len(starts), hashlib.sha256(kept).hexdigest(), starts.astype(np.int64), stops.astype(np.int64))
        out.append((*row, kept) if texts else row)
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "stops", *["kept"] * texts])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, texts: bool = True
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, stops[, kept]).

    Texts are their UTF-8 bytes; null and empty texts have none.  starts and stops bound the maximal removed runs of bytes; kept
    (if ``texts``) holds the other bytes, concatenated.  Strings are judged on the input and never cross documents.  Rows with equal ids,
    repeated rows among them, are never each other's smaller document; a null id counts as the largest there can be.  Texts
    under ``length`` bytes lose nothing.  Other columns are ignored.  An empty table gives an empty one.
    """
    if not 16 <= anchor <= length <= 127:
        raise ValueError("16 <= anchor <= length <= 127 must hold")
    table = segments(docs, id_col, text_col)
    total = table.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = min(MOST_RANGES, max(64, -(-2 * total // BUCKET_BYTES)))  # packed bytes are about half
    every = max(1, 2 * total // (buckets * RANGE_SAMPLE * 14))  # one anchor in some 14 bytes

    def each(pdfs: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in pdfs:
            yield from pdf.itertuples(index=False)

    def send_hashes(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in each(pdfs):
            seg = Segment(r.ids, r.ends, r.text, length, anchor)
            yield pd.DataFrame([(r.segment, *x) for x in _Hashes(seg, buckets).runs(every)], columns=["segment", "bucket", "hashes", "several", "heavy", "sample"])

    sent = table.mapInPandas(send_hashes, "segment long, bucket int, hashes binary, several binary, heavy binary, sample binary")
    bits = sent.groupBy("bucket").applyInPandas(lambda pdf: _answer_hashes(pdf, anchor), "segment long, bucket int, bits binary")
    bits = materialise(bits, "answers")
    release_shuffles(table.sparkSession)

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"splitters": [choose_splitters(b"".join(pdf["bits"]), anchor, buckets)]})

    # The sample has some RANGE_SAMPLE strings for each of MOST_RANGES ranges at most, whatever the table's size.
    found = only_row(bits.where("segment = -1").groupBy().applyInPandas(split, "splitters binary"))
    shared = table.sparkSession.sparkContext.broadcast(bytes(found["splitters"]) if found else b"")

    def send_runs(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitters = np.frombuffer(shared.value, f"S{anchor}")
        for r in each(pdfs):
            seg = Segment(r.ids, r.ends, r.text, length, anchor)
            wanted, hot = _Hashes(seg, buckets).wanted(dict(zip(r.buckets, r.answers, strict=True)))
            runs, notes = suffix_runs(seg, wanted, hot, splitters, buckets)
            out = [(r.segment, b, b, front_code(k, i)) for b, (k, i) in runs.items()]
            # Notes travel with the runs, to any bucket, and come back with the answers.
            out.append((r.segment, r.segment % 1_000_003 % buckets, -1, notes))
            yield pd.DataFrame(out, columns=["segment", "goes", "bucket", "run"])

    known = _with_answers(table, bits.where("segment >= 0"), "bits")
    runs = known.mapInPandas(send_runs, "segment long, goes int, bucket int, run binary")
    merged = runs.groupBy("goes").applyInPandas(lambda pdf: _answer_runs(pdf, length, anchor), "segment long, bucket int, least binary")
    merged = materialise(merged, "answers")
    discard(bits)
    release_shuffles(table.sparkSession)
    both = _with_answers(table, merged, "least")

    def cut(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in each(pdfs):
            answers = dict(zip(r.buckets, r.answers, strict=True))
            ids, ends = np.frombuffer(r.ids, np.int64), np.frombuffer(r.ends, np.int64)
            covered = _covered(ids, ends, length, answers.pop(-1), answers)
            yield _cut(ids, np.unpackbits(np.frombuffer(r.nulls, np.uint8))[: len(ids)], ends, _unpack(r.text), covered, texts)

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, stops array<long>"
    return both.mapInPandas(cut, out + ", kept binary" * texts)


def _with_answers(table: DataFrame, answers: DataFrame, col: str) -> DataFrame:
    """Each segment's row with the answers that it got, as two arrays (empty if none)."""
    own = answers.groupBy("segment").agg(F.collect_list(F.struct("bucket", col)).alias("all"))
    own = own.select("segment", F.col("all.bucket").alias("buckets"), F.col(f"all.{col}").alias("answers"))
    joined = table.join(own, "segment", "left")
    empty = {"buckets": F.array().cast("array<int>"), "answers": F.array().cast("array<binary>")}
    return joined.withColumns({c: F.coalesce(c, e) for c, e in empty.items()})
