"""Token stores: exact ids, round trips and the file format."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from runlens.llm import tokenfile

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aB'sS’té.,%|<> \n\tÉñß1２½İḰ̸  中文#'ll'd'm're've　ﬁ\x1c\x85-_ΑΣς"


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(library, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(80))) for _ in range(1500)]
    texts += [None, "", "<|endoftext|> x", "<|EndOfText|>", "don't can't 'tis rock'n'roll", "H̱ ẖ K̸", "a%b%%c d.e,f", "word " * 500]
    for most in (1_000_000, 50):  # the second forgets again and again
        monkeypatch.setattr(tokenfile, "CACHE_PIECES", most)
        own = tokenfile.Encoder(PATH)
        for got, text in zip(own.encode(pa.array(texts, pa.string())), texts, strict=True):
            assert got.tolist() == ids_of(library, text)


def test_store(spark, docs_of, library, tmp_path):
    rng = random.Random(2)
    words = [("".join(rng.choice("abcdefghé") for _ in range(rng.randrange(1, 9)))) for _ in range(300)]
    rows = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.randrange(80)))) for i in rng.sample(range(1000), 400)]
    rows += [(7000, None), (7001, ""), (7002, "long " * 60_000), (7003, "same"), (7003, "same"), (None, "no id"), (-5, "first")]
    path = str(tmp_path / "store")
    tokenfile.write(docs_of(rows), path, PATH, shard_bytes=4000)
    got = sorted(tokenfile.read(spark, path, ids=True).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    at = 0
    for r, (i, text) in zip(got, order, strict=True):
        want = ids_of(library, text) + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], list(r["ids"])) == (i, at, len(want), want)
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        at += len(want)
    shards = spark.read.format("binaryFile").load(path + "/shards").count()
    assert shards > 3 and spark.read.json(path + "/manifest").count() == shards
    dictionary = bytes(spark.read.parquet(path + "/dictionary").first()[0])
    assert len(dictionary) > 0
    content = spark.read.format("binaryFile").load(path + "/shards").first()["content"]
    shard = tokenfile.Shard(bytes(content), dictionary)
    assert all(len(shard.document(k)) == shard.tokens[k] for k in (0, len(shard.ids) - 1))
    with pytest.raises(ValueError):
        tokenfile.Shard(bytes(content), b"another dictionary")
    with pytest.raises(ValueError):
        tokenfile.Shard(bytes(content[:-1]), dictionary)


def test_empty_and_tiny(spark, docs_of, tmp_path):
    tokenfile.write(docs_of([]), str(tmp_path / "none"), PATH)
    none = tokenfile.read(spark, str(tmp_path / "none"))
    assert none.count() == 0 and none.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    tokenfile.write(docs_of([(1, "a"), (None, None)]), str(tmp_path / "two"), PATH)
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in tokenfile.read(spark, str(tmp_path / "two")).orderBy("start").collect()] == [(1, 0, 2), (None, 2, 1)]


def test_wide_ids():
    frames = [b"x", b"yy"]
    shard = tokenfile.Shard(tokenfile.build_shard([1, None], [3, 4], frames, 4, b""), b"")
    assert shard.ids == [1, None] and shard.dtype == "<u4" and tokenfile.id_type(70_000) == "<u4"


CASED = "Hello World, it's Fine.  Two  spaces\tand\n\nlines; ÉCOLE's İ 123,456 <|endoftext|> x"


def test_any_other_tokenizer_is_taken_whole(spark, docs_of, tmp_path):
    """A cased byte-level vocabulary: ids are the library's own, in columns of texts and through a store."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    cased = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = [CASED, None, "", " ", *["".join(rng.choice(ALPHABET + "ABC xyz") for _ in range(rng.randrange(120))) for _ in range(500)]]
    own = tokenfile.Encoder(path)
    assert not own.by_pieces and tokenfile.Encoder(PATH).by_pieces
    for got, text in zip(own.encode(pa.array(texts, pa.string())), texts, strict=True):
        assert got.tolist() == ids_of(cased, text)
    assert len(ids_of(cased, "Hello World, it's Fine.")) < 10
    store = str(tmp_path / "cased")
    tokenfile.write(docs_of(list(enumerate(texts))), store, path, end_id=50256)
    got = {r["doc_id"]: list(r["ids"]) for r in tokenfile.read(spark, store, ids=True).collect()}
    assert got == {i: [*ids_of(cased, t), 50256] for i, t in enumerate(texts)}


@pytest.mark.parametrize("part,value", [("normalizer", {"type": "Lowercase"}), ("normalizer", None), ("pre_tokenizer", {"type": "Whitespace"}), ("post_processor", {"type": "x"})])
def test_pieces_only_where_the_file_warrants_them(library, part, value):
    import json

    spec = json.loads(library.to_str())
    assert tokenfile.by_pieces(spec) and not tokenfile.by_pieces(spec | {part: value})
    assert not tokenfile.by_pieces(spec | {"added_tokens": [{"content": "plain"}]})


def test_the_manifest_counts_what_the_files_hold(spark, docs_of, tmp_path):
    path = str(tmp_path / "counted")
    tokenfile.write(docs_of([(i, "some words " * (i % 40)) for i in range(400)]), path, PATH, shard_bytes=3000)
    told = {r["shard"]: (r["documents"], r["tokens"]) for r in spark.read.json(path + "/manifest").collect()}
    dictionary = bytes(spark.read.parquet(path + "/dictionary").first()[0])
    read = {}
    for r in spark.read.format("binaryFile").load(path + "/shards").collect():
        shard = tokenfile.Shard(bytes(r["content"]), dictionary)
        read[r["shard"]] = (len(shard.ids), int(shard.tokens.sum()))
    assert told == read and len(read) > 2


def test_the_dictionary_is_trained_on_bounded_parts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(tokenfile, "PART_BYTES", 64)
    docs = docs_of([(i, " ".join(f"word{(i * k) % 97}" for k in range(300))) for i in range(60)])
    whole = tokenfile.train_dictionary(docs, "doc_id", "text", PATH, 2, 2000, 4 << 10)
    monkeypatch.setattr(tokenfile, "DICTIONARY_PARTS", 200)
    few = tokenfile.train_dictionary(docs.repartition(3), "doc_id", "text", PATH, 2, 2000, 4 << 10)
    assert few and whole and few != whole
    assert few == tokenfile.train_dictionary(docs, "doc_id", "text", PATH, 2, 2000, 4 << 10)
