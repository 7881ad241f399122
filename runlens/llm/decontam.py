"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

An item is contained in a document if the document has at least ``threshold`` of the item's distinct word shingles.
Items are partitioned by their number of shingles.  An item's signature is its k smallest shingle hashes, where
k follows from its partition's size alone: an item of q shingles may miss at most q - ceil(threshold * q) of them, so
one more than that many minima can't all be missing.  A document that contains an item therefore has one of the item's
minima among its own shingles, however long the document is; no band or estimate can miss it.  Every (document, item)
pair found so is verified by exact containment of the shingles themselves, as strings.

The signatures are broadcast while they are few (``MOST_MINIMA``); beyond that the documents' shingle hashes are joined to
them by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialise, plain
from ._words import ngram_hashes, slices, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Signature hashes that are broadcast at most (16 bytes each, besides the texts of the items).
MOST_MINIMA = 500_000
MOST_ITEM_BYTES = 64 << 20
#: Keys that a shingle is parted into where signatures are joined.
SALTS = 16


def shingles(text: str | None, n: int = SHINGLE_WORDS) -> list[bytes]:
    """The distinct word shingles of a text, A-Z lower-cased: of n words each, or the whole text if it has fewer words."""
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return [b" ".join(words)] if words else []
    return list(dict.fromkeys(map(b" ".join, zip(*(words[i : len(words) - n + 1 + i] for i in range(n)), strict=True))))


def minima(q: int, threshold: float = THRESHOLD) -> int:
    """How many minima an item of q shingles needs: one more than it may miss."""
    return q - ceil(Fraction(str(threshold)) * q) + 1


def _shingle_hash(shingle: bytes) -> np.uint64:
    """The hash that ``ngram_hashes`` gives the shingle's words."""
    words = np.array([xxhash.xxh64_intdigest(w) for w in shingle.split()], dtype=np.uint64)
    return ngram_hashes(words, np.array([0, len(words)]), len(words))[0][0]


def signatures(items: DataFrame, n: int, threshold: float) -> DataFrame:
    """(item_id, words, hash) of (item_id, item_text): each item's minima; words is its shingles' length, below n if it is shorter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, text in zip(pdf["item_id"], pdf["item_text"], strict=True):
                own = shingles(text, n)
                found = sorted(int(_shingle_hash(s)) for s in own)[: minima(len(own), threshold) if own else 0]
                out += [(i, len(own[0].split()), h - (1 << 64) * (h >> 63)) for h in found]
            yield pd.DataFrame(out, columns=["item_id", "words", "hash"])

    return items.mapInPandas(run, "item_id long, words int, hash long")


def _verify(text: bytes, wanted: list[list[bytes]], n: int) -> list[int]:
    """For each item's shingles, how many the text has."""
    words = text.lower().split()
    have = {}
    out = []
    for own in wanted:
        size = own[0].count(b" ") + 1 if own else n
        if size not in have:
            last = len(words) - size + 1
            have[size] = set(map(b" ".join, zip(*(words[i : last + i] for i in range(size)), strict=True))) if last > 0 else set()
        out.append(sum(s in have[size] for s in own))
    return out


def contained(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    n: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, shingles, found): the pairs where the document has ``threshold`` of the item's shingles or more.

    One row for each pair and each row of ``docs`` (a repeated row repeats its pairs).  Items without words, and null or empty
    documents, are in no pair; an item shorter than n words is one shingle of all its words.  Repeated item rows with one id and
    different texts count as one item for each text.  A null doc_id is kept; items with a null id are left out.  Other columns
    are ignored.  Empty tables give an empty one.
    """
    rows, i, t = plain(docs, id_col, text_col)
    rows = rows.select(F.col(i).cast("long").alias("doc_id"), F.col(t).cast("string").alias("text"))
    index = _Index(items, item_id_col, item_text_col, n, threshold)
    if not index.size:
        return rows.sparkSession.createDataFrame([], _OUT)
    if not index.small:
        return _by_shuffle(rows.withColumn("row", F.monotonically_increasing_id()), index).select("doc_id", *_FOUND)
    finder = index.finder()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder()
        for batch in batches:
            found = find(batch.column(1))
            ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
            rest = [pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([ids, *rest], names=["doc_id", *_FOUND])

    return rows.mapInArrow(run, _OUT)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    n: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs``, all columns kept, that contain no item by the rules of ``contained``; null texts stay."""
    index = _Index(items, item_id_col, item_text_col, n, threshold)
    if not index.size:
        return docs
    rows, text = plain(docs, text_col)
    if not index.small:
        kept = materialise(rows.select(F.monotonically_increasing_id().alias("row"), F.struct(*rows.columns).alias("own")), "documents")
        texts = kept.select(F.lit(None).cast("long").alias("doc_id"), F.col("own")[text].cast("string").alias("text"), "row")
        return kept.join(_by_shuffle(texts, index).select("row").distinct(), "row", "left_anti").select("own.*").toDF(*docs.columns)
    finder, at = index.finder(), rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder()
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[f[0] for f in find(batch.column(at))]] = False
            yield batch.filter(pa.array(clean))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)


_FOUND = ("item_id", "shingles", "found")
_OUT = "doc_id long, item_id long, shingles long, found long"


class _Index:
    """The items' signatures and texts, and how large they are."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, n: int, threshold: float) -> None:
        self.n, self.need = n, Fraction(str(threshold))
        rows, i, t = plain(items, id_col, text_col)
        self.items = rows.select(F.col(i).cast("long").alias("item_id"), F.col(t).cast("string").alias("item_text"))
        self.items = self.items.where("item_id is not null and item_text is not null").distinct()
        self.signatures = materialise(signatures(self.items, n, threshold).distinct(), "signatures")
        self.size = self.signatures.count()
        weight = self.items.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()[0]
        self.small = self.size <= MOST_MINIMA and weight <= MOST_ITEM_BYTES
        self.lengths = sorted(r[0] for r in self.signatures.select("words").distinct().collect())  # n values at most

    def finder(self):
        """Broadcasts the index; gives what makes, on an executor, the search of a column of texts."""
        table = self.signatures.toPandas()
        keys = table["hash"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys, kind="stable")
        keys, of = keys[order], table["item_id"].to_numpy(np.int64)[order]
        texts: dict[int, list[str]] = {}
        for r in self.items.collect():
            texts.setdefault(r["item_id"], []).append(r["item_text"])
        shared = self.items.sparkSession.sparkContext.broadcast((keys, of, texts))
        lengths, n, need = self.lengths, self.n, self.need

        def make():
            keys, of, texts = shared.value
            wanted = {i: [shingles(t, n) for t in own] for i, own in texts.items()}
            first_bits = np.zeros(1 << 22, bool)
            first_bits[keys >> np.uint64(42)] = True

            def find(column: pa.Array) -> list[tuple[int, int, int, int]]:
                """(row, item, shingles, found) of every containment in the column."""
                out = []
                for start, stop in slices(column):
                    part = column.slice(start, stop - start)
                    words = words_of(part)
                    hashes = words.hashes()
                    pairs = set()
                    for length in lengths:
                        h, first = ngram_hashes(hashes, words.bounds, length)
                        hit = np.flatnonzero(first_bits[h >> np.uint64(42)])
                        lo, hi = np.searchsorted(keys, h[hit], "left"), np.searchsorted(keys, h[hit], "right")
                        for k in np.flatnonzero(hi > lo):
                            row = int(np.searchsorted(words.bounds, first[hit[k]], side="right")) - 1
                            pairs.update((row, int(i)) for i in of[lo[k] : hi[k]])
                    by_row: dict[int, list[int]] = {}
                    for row, item in sorted(pairs):
                        by_row.setdefault(row, []).append(item)
                    for row, items in by_row.items():
                        tests = [(i, own) for i in items for own in wanted[i] if own]
                        counts = _verify(part[row].as_py().encode(), [own for _, own in tests], n)
                        out += [(start + row, i, len(own), c) for (i, own), c in zip(tests, counts, strict=True) if c >= need * len(own)]
                return out

            return find

        return make


def _by_shuffle(rows: DataFrame, index: _Index) -> DataFrame:
    """(row, doc_id, item_id, shingles, found) with nothing broadcast: candidates by a join on hashes, to which texts are brought.

    ``rows`` has row (a number of its own for each), doc_id and text.
    """
    rows = materialise(rows, "documents")
    lengths, n, need = index.lengths, index.n, index.need

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                words = words_of(batch.column(1).slice(start, stop - start))
                own, ids = words.hashes(), np.asarray(batch.column(0))[start:stop]
                for length in lengths:
                    h, first = ngram_hashes(own, words.bounds, length)
                    of = np.searchsorted(words.bounds, first, side="right") - 1
                    found = pd.DataFrame({"row": ids[of], "hash": h.view(np.int64)}).drop_duplicates()
                    yield pa.RecordBatch.from_pandas(found.assign(words=np.int32(length)), preserve_index=False)

    grams = rows.select("row", "text").mapInArrow(hashes, "row long, hash long, words int").withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)).cast("int"))
    # A shingle that very many documents have is as many keys as there are salts.
    minima_of = index.signatures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = grams.join(minima_of, ["hash", "words", "salt"]).select("row", "item_id").distinct()
    texts = pairs.join(index.items, "item_id").join(rows, "row").select("row", "doc_id", "text", "item_id", "item_text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, counts = [], [], []
            for k, (text, other) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                own = shingles(other, n)
                count = _verify(text.encode(), [own], n)[0] if own else 0
                if own and count >= need * len(own):
                    kept.append(k), sizes.append(len(own)), counts.append(count)
            take = pa.array(kept, pa.int64())
            cols = [batch.column(c).take(take) for c in (0, 1, 3)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["row", "doc_id", *_FOUND])

    return texts.mapInArrow(verify, "row long, " + _OUT)
