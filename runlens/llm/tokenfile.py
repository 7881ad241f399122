"""Token ids in a binary file format with a shared zstandard dictionary.

Every document's ids, an end id appended, are serialized as little-endian integers (two bytes where the vocabulary allows it) and
compressed on their own with a dictionary that was trained on serialized id arrays.  So a short document is read by one seek and
one small decompression.

A store is a folder in any file system that Spark writes: ``shards/shard=N/documents=D/tokens=T/`` has one file each, ``dictionary/`` the
dictionary, and ``manifest/`` one JSON line for each shard.  A shard file, all integers little-endian::

    "RLTOKID1"                                     magic
    frames                                         one zstandard frame for each document, in ascending order of ids
    n x (id i64, null u8 as i64, tokens i64)       the documents
    (n + 1) x offset i64                           frames' places, from the file's start
    n i64, width i64, dictionary i64, index i64    number of documents, bytes of an id, xxh64 of the dictionary, place of the index
    "RLTOKEND\\n"

Ids come from the tokenizer's own library.  With most tokenizers a text is encoded as a whole.  Where the tokenizer's file says that it lower-cases,
drops white space and splits by the pattern ``WORDS`` (``by_pieces``), white space parts tokens, and so do the borders of ASCII letters and digits
with ASCII signs other than the apostrophe; pieces between such borders are then encoded one by one, each distinct piece once per worker
while a bounded cache holds it, and put together by index arithmetic.  A text for which a piece could depend on its surroundings
(special tokens, combining marks) is encoded as a whole even so.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._store import discard, materialise, only_row, plain
from ._words import slices, text_buffers

END_ID = 2
MAGIC, TAIL = b"RLTOKID1", b"RLTOKEND\n"
#: Documents that the dictionary is trained on at most, parts of their serialized ids at most, bytes of a part, and the dictionary's size.
DICTIONARY_ROWS, DICTIONARY_PARTS, PART_BYTES, DICTIONARY_BYTES = 2000, 4000, 16 << 10, 64 << 10
#: Bytes of frames in a shard (one document at least), and distinct pieces that a worker's cache holds.
SHARD_BYTES, CACHE_PIECES = 4 << 20, 400_000
LEVEL = 3
#: Bytes of text that are taken apart at a time: with more, fewer pieces are looked up twice.
SLICE_BYTES = 4 << 20
_NO_ID = np.iinfo(np.int64).max

_CLASS = np.full(256, 3, np.uint8)  # 0 space, 1 sign, 2 letter or digit, 3 anything else
_CLASS[[0x20, 9, 10, 11, 12, 13]] = 0
_CLASS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = 1
_CLASS[[b for b in range(0x30, 0x7B) if chr(b).isalnum()]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: A piece that is one pre-token whatever stands around it; how many are joined to one text.
_PLAIN, _JOINED = re.compile("[a-zÀ-ÖØ-öø-ÿ]+"), 2000


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


#: How a tokenizer's file must describe its splitting for texts to be encoded by pieces.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]


def by_pieces(spec: dict) -> bool:
    """Whether a tokenizer's description warrants that pieces of a text have the ids that they have in the text."""
    normalizer, splitter, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    steps = splitter.get("pretokenizers") or []
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        and (steps[0].get("pattern"), steps[0].get("behavior"), steps[0].get("invert")) == ({"Regex": WORDS}, "Removed", True)
        and not steps[1].get("use_regex")
        and not steps[1].get("add_prefix_space")
        and spec.get("post_processor") is None
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and not spec.get("truncation")
        and not spec.get("padding")
        and all(t["content"].startswith("<|") for t in spec.get("added_tokens") or [])
    )


class Encoder:
    """Encodes columns of texts with a tokenizer file, keeping the ids of pieces it has met."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.by_pieces = by_pieces(json.loads(self.tokenizer.to_str()))
        self.ends_word = np.zeros(self.vocabulary, bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool, self.used = np.empty(1 << 20, np.uint32), 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.missed = 0

    def whole(self, texts: list[str]) -> list[list[int]]:
        """The library's ids of whole texts."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many belong to each piece) of pieces that aren't known.

        Words of plain letters are one pre-token each and their last id marks a word's end, so many of them go to the library as one
        text and are told apart again by those marks; all other pieces go as texts of their own.
        """
        texts = [p.decode("utf-8") for p in pieces]
        plain = [i for i, t in enumerate(texts) if _PLAIN.fullmatch(t)]
        rest = [i for i, t in enumerate(texts) if not _PLAIN.fullmatch(t)]
        flat, sizes, order = [], [], []
        for k in range(0, len(plain), _JOINED):
            own = plain[k : k + _JOINED]
            ids = np.array(self.whole([" ".join([texts[i] for i in own])])[0], np.uint32)
            ends = np.flatnonzero(self.ends_word[ids])
            if len(ends) != len(own) or (len(ids) and ends[-1] != len(ids) - 1):  # a vocabulary without such marks
                rest += own
                continue
            flat.append(ids)
            sizes.append(np.diff(ends, prepend=-1))
            order += own
        found = self.whole([texts[i] for i in rest])
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat.append(np.fromiter((i for f in found for i in f), np.uint32, int(sizes[-1].sum())))
        order += rest
        ids, sizes = np.concatenate(flat), np.concatenate(sizes).astype(np.int64)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        starts = (np.cumsum(sizes) - sizes)[back]
        return ids[_ranges(starts, sizes[back])], sizes[back]

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece in the pool.  What the full cache has no room for stands in the pool until the next call."""
        kept = len(self.known)
        self.starts, self.sizes = self.starts[:kept], self.sizes[:kept]
        self.used = int(self.starts[-1] + self.sizes[-1]) if kept else 0
        if self.missed > 4 * CACHE_PIECES:
            self._reset()
        places = np.fromiter((self.known.get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(places < 0)
        if len(new):
            ids, sizes = self._fresh([pieces[i] for i in new])
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty(len(self.pool), np.uint32)])
            self.pool[self.used : self.used + len(ids)] = ids
            places[new] = np.arange(len(self.starts), len(self.starts) + len(new))
            room = max(0, CACHE_PIECES - len(self.known))
            self.known.update((pieces[i], int(places[i])) for i in new[:room])
            self.missed += max(0, len(new) - room)
            self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
        return places

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, whole; null and empty texts have none."""
        for start, stop in slices(texts, SLICE_BYTES):
            part = texts.slice(start, stop - start)
            if self.by_pieces:
                yield from self._encode(part)
            else:
                yield from (np.array(ids, np.uint32) for ids in self.whole([t or "" for t in part.to_pylist()]))

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        data, off = text_buffers(texts)
        n = len(off) - 1
        if not len(data):
            return [np.zeros(0, np.uint32)] * n
        marks = np.flatnonzero((data == 0xCC) | (data == 0xCD) | ((data == 0x3C) & (np.append(data[1:], np.uint8(0)) == 0x7C)))
        slow = set((np.searchsorted(off, marks, side="right") - 1).tolist())
        kind = _CLASS[data]
        solid = kind > 0
        before = np.concatenate([[np.uint8(0)], kind[:-1]])
        before[off[:-1][off[:-1] < len(data)]] = 0
        starts = solid & ((before == 0) | ((before + kind == 3) & (before != 3) & (kind != 3)))
        at = np.flatnonzero(starts)
        bounds = np.searchsorted(at, off)
        packed = _LOWER[data[solid]]
        offsets = np.append(np.cumsum(solid, dtype=np.int64)[at] - 1, len(packed))
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
        place = self._places(column.dictionary.to_pylist())[column.indices.to_numpy(zero_copy_only=False)] if len(at) else np.zeros(0, np.int64)
        sizes = self.sizes[place]
        flat = self.pool[_ranges(self.starts[place], sizes)]
        cut = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        out = [flat[cut[i] : cut[i + 1]] for i in range(n)]
        for i in slow:
            out[i] = np.array(self.whole([texts[i].as_py()])[0], np.uint32)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def train_dictionary(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, rows: int, size: int) -> bytes:
    """A zstandard dictionary from the serialized ids of at most ``rows`` documents, those with the smallest digests of their ids.

    Ids are taken in parts of ``PART_BYTES``; of more than ``DICTIONARY_PARTS`` those with the smallest digests of document and place, so what one
    task trains on is bounded however long the documents are.  If the samples are too few or too small for training, the dictionary is empty and frames need none.
    """
    docs, i, t = plain(docs, id_col, text_col)
    picked = docs.select(F.col(i).cast("long").alias("id")).where("id is not null").withColumn("pick", F.md5(F.col("id").cast("string")))
    picked = picked.orderBy("pick").limit(rows).select("id").distinct()
    texts = docs.select(F.col(i).cast("long").alias("id"), F.col(t).cast("string").alias("text")).join(F.broadcast(picked), "id")

    schema = pa.schema([("id", pa.int64()), ("part", pa.int64()), ("ids", pa.binary())])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            dtype = id_type(own.vocabulary)
            for doc, x in zip(batch.column(0).to_pylist(), own.encode(batch.column(1)), strict=True):
                raw = np.append(x, end_id).astype(dtype).tobytes()
                parts = [raw[i : i + PART_BYTES] for i in range(0, len(raw), PART_BYTES)]
                yield pa.RecordBatch.from_pydict({"id": [doc] * len(parts), "part": list(range(len(parts))), "ids": parts}, schema)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            own = pdf.sort_values(["id", "part", "ids"])["ids"]
            trained = zstandard.train_dictionary(size, list(own)).as_bytes()
        except zstandard.ZstdError:
            trained = b""
        return pd.DataFrame({"dictionary": [trained]})

    parts = texts.select("id", "text").mapInArrow(sample, "id long, part long, ids binary")
    parts = parts.withColumn("pick", F.md5(F.concat_ws("/", "id", "part"))).orderBy("pick", "ids").limit(DICTIONARY_PARTS).select("id", "part", "ids")
    found = only_row(parts.groupBy().applyInPandas(fit, "dictionary binary"))
    return bytes(found["dictionary"]) if found else b""


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _compressor(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)


def _decompressor(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=data)


def build_shard(ids: list[int | None], tokens: list[int], frames: list[bytes], width: int, dictionary: bytes) -> bytes:
    """A shard file's bytes."""
    docs = np.array([[_NO_ID if i is None else i, i is None, t] for i, t in zip(ids, tokens, strict=True)], "<i8").reshape(-1, 3)
    offsets = len(MAGIC) + np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<i8")
    end = np.array([len(ids), width, np.uint64(xxhash.xxh64_intdigest(dictionary)).astype(np.int64), offsets[-1]], "<i8")
    return MAGIC + b"".join(frames) + docs.tobytes() + offsets.tobytes() + end.tobytes() + TAIL


class Shard:
    """A shard file, read from its bytes."""

    def __init__(self, content: bytes, dictionary: bytes) -> None:
        end = len(content) - len(TAIL)
        if content[: len(MAGIC)] != MAGIC or content[end:] != TAIL:
            raise ValueError("not a shard file")
        n, width, digest, index = np.frombuffer(content, "<i8", 4, end - 32).tolist()
        if digest != int(np.uint64(xxhash.xxh64_intdigest(dictionary)).astype(np.int64)):
            raise ValueError("the shard was written with another dictionary")
        docs = np.frombuffer(content, "<i8", 3 * n, index).reshape(n, 3)
        self.ids = [None if null else i for i, null, _ in docs.tolist()]
        self.tokens = docs[:, 2]
        self.offsets = np.frombuffer(content, "<i8", n + 1, index + 24 * n)
        self.content, self.dtype, self.unzip = content, f"<u{width}", _decompressor(dictionary)

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's document k: one slice and one decompression."""
        size = int(self.tokens[k]) * int(self.dtype[2:])
        raw = self.unzip.decompress(self.content[self.offsets[k] : self.offsets[k + 1]], max_output_size=max(1, size))
        if len(raw) != size:
            raise ValueError("a frame doesn't have the ids that the index says")
        return np.frombuffer(raw, self.dtype)


def write(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_bytes: int = SHARD_BYTES
) -> None:
    """Encode every row's whole text and write the store at ``path``.

    Documents stand in ascending order of ids, null ids last; rows with one id (repeated rows too) are ordered by their ids'
    number and frame.  Null and empty texts are the end id alone.  Other columns are ignored.  An empty table makes a store
    without shards.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, id_col, text_col, tokenizer, end_id, DICTIONARY_ROWS, DICTIONARY_BYTES)
    shared = spark.sparkContext.broadcast(dictionary)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, zip_ = encoder(tokenizer), _compressor(shared.value)
        dtype = id_type(max(own.vocabulary, end_id + 1))
        for batch in batches:
            sizes, packed = [], []
            for x in own.encode(batch.column(1)):
                packed.append(zip_.compress(np.append(x, np.uint32(end_id)).astype(dtype).tobytes()))
                sizes.append(len(x) + 1)
            width = pa.array([int(dtype[2:])] * len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), width, pa.array(packed, pa.binary())], names=["doc_id", "n", "width", "frame"])

    rows, i, t = plain(docs, id_col, text_col)
    rows = rows.select(F.col(i).cast("long").alias("doc_id"), F.col(t).cast("string").alias("text"))
    encoded = materialise(rows.mapInArrow(frames, "doc_id long, n long, width int, frame binary"), "frames", compression="uncompressed")
    total = encoded.select(F.coalesce(F.sum(F.octet_length("frame")), F.lit(0))).first()[0]
    parts = max(1, -(-total // shard_bytes))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = k = held = 0
        ids, tokens, own = [], [], []

        def out() -> pa.RecordBatch:
            content = build_shard(ids, tokens, own, width, shared.value)
            told = [pa.array([x], pa.int64()) for x in (part << 24 | k, len(ids), sum(tokens))]
            return pa.RecordBatch.from_arrays([*told, pa.array([content[:-1]], pa.binary())], names=["shard", "documents", "tokens", "value"])

        for batch in batches:
            for i, n, width, frame, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(i), tokens.append(n), own.append(frame)
                held += len(frame)
                if held >= shard_bytes + shard_bytes // 2:
                    yield out()
                    ids, tokens, own, held, k = [], [], [], 0, k + 1
        if own:
            yield out()

    order = [F.col("doc_id").asc_nulls_last(), F.col("n"), F.col("frame")]
    ranged = encoded.repartitionByRange(parts, F.col("doc_id").asc_nulls_last()).sortWithinPartitions(*order)
    files = ranged.select("doc_id", "n", "width", "frame", F.spark_partition_id().alias("part")).mapInArrow(shards, "shard long, documents long, tokens long, value binary")
    # The text writer writes a string's bytes as they are and a line end after each row: a shard file ends in one.
    # What the manifest counts stands in the folders' names, so no file is read for it.
    files.withColumn("value", F.col("value").cast("string")).write.partitionBy("shard", "documents", "tokens").text(f"{path}/shards")
    discard(encoded)
    spark.range(1).select(F.lit(bytearray(dictionary)).alias("dictionary")).write.parquet(f"{path}/dictionary")
    if not total:
        empty = "shard long, documents long, tokens long, start long, dictionary string"
        spark.createDataFrame([], empty).write.json(f"{path}/manifest")
        return
    counted = spark.read.format("binaryFile").load(f"{path}/shards").select(*[F.col(c).cast("long").alias(c) for c in ("shard", "documents", "tokens")])
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted.withColumn("start", before).withColumn("dictionary", F.lit(f"{xxhash.xxh64_intdigest(dictionary):016x}")).coalesce(1).write.json(f"{path}/manifest")


def _each_shard(spark: SparkSession, path: str, dictionary: bytes, f, schema: str) -> DataFrame:
    """Rows of ``f`` for each shard file, with the shard's number first."""
    shared = spark.sparkContext.broadcast(dictionary)
    names = ["shard", *[c.split()[0] for c in schema.split(", ")]]

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for r in pdf.itertuples(index=False):
                rows = f(Shard(r.content, shared.value))
                yield pd.DataFrame(rows, columns=names[1:]).assign(shard=r.shard)[names].convert_dtypes()

    files = spark.read.format("binaryFile").load(f"{path}/shards").select(F.col("shard").cast("long").alias("shard"), "content")
    return files.mapInPandas(run, "shard long, " + schema)


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of a store, from its files.

    start counts the ids of all documents before it; the crc is that of all its ids as little-endian 32-bit integers.
    """
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()[0])
    manifest = spark.read.schema("shard long, documents long, tokens long, start long, dictionary string").json(f"{path}/manifest")
    schema = "doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids

    def rows(shard: Shard) -> list[tuple]:
        before = np.cumsum(shard.tokens) - shard.tokens
        out = []
        for k, i in enumerate(shard.ids):
            own = shard.document(k)
            row = (i, int(before[k]), len(own), zlib.crc32(own.astype("<u4").tobytes()))
            out.append((*row, own.astype(np.int64)) if ids else row)
        return out

    if manifest.isEmpty():
        return spark.createDataFrame([], schema.replace("before", "start"))
    found = _each_shard(spark, path, dictionary, rows, schema).join(manifest.select("shard", F.col("start").alias("_start")), "shard")
    return found.select("doc_id", (F.col("_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)
