"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal updates.

Two streams of words are hashed: the words as they are, and their shapes (letters, digits and signs without the
letters themselves, or a mark for a word that repeats the one before it).  N-grams of both fall into one table
of 2**bits weights; a text's features are the distinct n-grams' slots with log-scaled counts, normalised to length
one.  A score is the logistic of a sparse dot product, so scoring is one pass over the rows with no shuffle.

The model is trained in one task on at most ``max_rows`` labelled rows (those with the smallest hashes of their ids) with at most
``max_bytes`` of features; both bounds are documented parameters.  The trained table has a fixed size and is what is broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import only_row, others, plain
from ._words import ngram_hashes, slices, words_of

#: Labelled rows that a model is fitted on at most, and bytes of their features at most (eight for each).
MAX_ROWS, MAX_BYTES = 12_000, 256 << 20
BITS = 18
WORD_NGRAMS = (1, 2)
SHAPE_NGRAMS = (1, 2, 3)
THRESHOLD = 0.7
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def _shape(word: bytes) -> bytes:
    text = word.decode("utf-8", "replace")
    return _DIGITS.sub("0", _LETTERS.sub("a", text)).encode()


def _shapes(words) -> np.ndarray:
    """A 64-bit hash of each word's shape."""
    own = (xxhash.xxh64_intdigest(b"\0" + _shape(w)) for w in words.vocabulary.to_pylist())
    table = np.fromiter(own, dtype=np.uint64, count=len(words.vocabulary))
    shapes = table[words.codes] if len(table) else np.zeros(0, np.uint64)
    again = np.zeros(len(shapes), bool)
    again[1:] = words.codes[1:] == words.codes[:-1]
    starts = words.bounds[:-1][words.bounds[:-1] < len(shapes)]
    again[starts] = False
    return np.where(again, np.uint64(0x5851F42D4C957F2D), shapes)


def features(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of the texts, in order: each text's bounds, and the slots and values of its features.

    A text without words has no features.
    """
    for start, stop in slices(texts):
        words = words_of(texts.slice(start, stop - start))
        n = stop - start
        keys = []
        for stream, sizes in ((words.hashes(), WORD_NGRAMS), (_shapes(words), SHAPE_NGRAMS)):
            for size in sizes:
                h, first = ngram_hashes(stream, words.bounds, size)
                slot = (h * np.uint64(2 * size + 1)) >> np.uint64(64 - bits)
                of = np.searchsorted(words.bounds, first, side="right") - 1
                keys.append(of.astype(np.uint64) << np.uint64(bits) | slot)
        found = np.sort(np.concatenate(keys))
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(found)))
        of = (found[at] >> np.uint64(bits)).astype(np.int64)
        slots = (found[at] & np.uint64((1 << bits) - 1)).astype(np.uint32)
        values = np.log1p(counts).astype(np.float32)
        length = np.sqrt(np.bincount(of, weights=values.astype(np.float64) ** 2, minlength=n))
        values = (values / length[of]).astype(np.float32)
        yield np.searchsorted(of, np.arange(n + 1)), slots, values


@dataclass
class Model:
    """Weights of all slots, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The probability of label 1 for every text; a text without words gets the bias's."""
        bits = int(len(self.weights)).bit_length() - 1
        out = []
        for bounds, slots, values in features(texts, bits):
            dot = np.concatenate([[0.0], np.cumsum(self.weights[slots].astype(np.float64) * values)])
            out.append(dot[bounds[1:]] - dot[bounds[:-1]] + self.bias)
        z = np.concatenate(out) if out else np.zeros(0)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """Follow-the-regularised-leader, proximal, with per-slot rates."""

    def __init__(self, bits: int, alpha: float = 4.0, beta: float = 1.0, l1: float = 0.1, l2: float = 0.0) -> None:
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.bias_z = self.bias_n = 0.0
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def _bias(self) -> float:
        return -self.bias_z / ((self.beta + self.bias_n**0.5) / self.alpha)

    def update(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        z, n = self.z[slots], self.n[slots]
        w, bias = self._weights(z, n), self._bias()
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ values + bias, -35, 35)))
        g = (p - label) * values
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[slots] = z + g - sigma * w
        self.n[slots] = n + g * g
        d = float(p - label)
        more = self.bias_n + d * d
        self.bias_z += d - (more**0.5 - self.bias_n**0.5) / self.alpha * bias
        self.bias_n = more

    def model(self) -> Model:
        return Model(self._weights(self.z, self.n).astype(np.float32), float(self._bias()))


def _fit(pdf: pd.DataFrame, bits: int, epochs: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["pick", "id"])
    slots = [np.frombuffer(x, np.uint32) for x in pdf["slots"]]
    values = [np.frombuffer(x, np.float32) for x in pdf["features"]]  # widened one at a time
    labels = pdf["label"].to_numpy()
    learner, rng = Ftrl(bits), np.random.default_rng(1)
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            learner.update(slots[i], values[i].astype(np.float64), int(labels[i]))
    model = learner.model()
    return pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
    bits: int = BITS,
    epochs: int = 2,
    max_bytes: int = MAX_BYTES,
) -> Model:
    """Fit a model on the labelled rows of ``docs``.

    Rows of ``labels`` with a null id, a label that is not 0 or 1, or an id without a document teach nothing.  An id
    with several labels counts with each of the different ones.  Of more than ``max_rows`` rows, those with the
    smallest hashes of their ids are taken, and of these the first whose features have at most ``max_bytes`` together.  Without any rows, every score is a half.
    """
    marked, i, own = plain(labels, id_col, label_col)
    picked = (
        marked.select(F.col(i).cast("long").alias("id"), F.col(own).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .distinct()
        .withColumn("pick", F.xxhash64("id", "label"))
        .orderBy("pick", "id")
        .limit(max_rows)
    )
    rows, i, t = plain(docs, id_col, text_col)
    rows = rows.select(F.col(i).cast("long").alias("id"), F.col(t).cast("string").alias("text"))
    rows = rows.join(F.broadcast(picked), "id")  # max_rows rows of three numbers at most

    names = ["id", "label", "pick", "slots", "features"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(3), 0
            for bounds, slots, values in features(texts, bits):
                n = len(bounds) - 1
                cut = [(slots[bounds[i] : bounds[i + 1]].tobytes(), values[bounds[i] : bounds[i + 1]].tobytes()) for i in range(n)]
                own = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), own.column(2), pa.array([c[0] for c in cut], pa.binary()), pa.array([c[1] for c in cut], pa.binary())],
                    names=names,
                )
                at += n

    found = rows.select("id", "label", "pick", "text").mapInArrow(extract, "id long, label int, pick long, slots binary, features binary")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0
        for batch in batches:  # in order; what is beyond the bound is read but not kept
            for row in zip(*(batch.column(c) for c in range(5)), strict=True):
                held += len(row[3].as_buffer()) + len(row[4].as_buffer())
                if held <= max_bytes:
                    kept.append([x.as_py() for x in row])
        if kept:
            yield pa.RecordBatch.from_pandas(_fit(pd.DataFrame(kept, columns=names), bits, epochs), preserve_index=False)

    # One task, which is sent its rows batch by batch.
    ordered = found.repartition(1).sortWithinPartitions("pick", "id", "label")
    fitted = only_row(ordered.mapInArrow(fit, "weights binary, bias double"))
    if fitted is None:
        return Model(np.zeros(1 << bits, np.float32), 0.0)
    return Model(np.frombuffer(fitted["weights"], np.float32), fitted["bias"])


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with one more column, each row's score between 0 and 1 (null and empty texts get the bias's).

    A column that is named like ``score_col``, in any case, is replaced.  Other columns pass unchanged; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, text = plain(docs, text_col)
    keep = others(docs.columns, (score_col,))
    own = [f"c{i}" for i in keep]
    rows = rows.select(*own, F.col(text).cast("string").alias("text"))
    schema = rows.select(*own).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.scores(batch.column(len(own))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*own, "score"])

    return rows.mapInArrow(run, schema).toDF(*[docs.columns[i] for i in keep], score_col)


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves the remainder 2 by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def remainder(doc_id: int) -> int:
    """What ``held_out`` compares with 2, in Python."""
    return zlib.crc32(str(doc_id).encode()) % 4
