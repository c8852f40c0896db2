import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from claimweave.llm import byte_bpe, queries

TEXTS = [
    (1, "Hello  world\n\n don't we'll 12345 ½ 漢字😀 naïve ÉTÉ"), (2, None), (3, ""), (4, " \n\t "), (5, "<|endoftext|> x"),
    (6, "a\x1cb x\x85y z​w"), (7, "a" * 30_000 + " " * 3_000 + "x"), (8, "日本語のテキスト" * 400), (9, "ab" * 3_000),
    (1, "repeated id"), (None, "no id"), (1, "repeated id"), (12, "a  b \n c\n d\u00a0 e \u2003f  "), (13, " x. ,y., Z,. "), (14, "w" * 700 + " " + "é" * 900),
    (10, "࢏ ౜x a\U000323b5b \U00011de0"), (11, "".join(f"tok{i}, " for i in range(9000))),
]


@pytest.fixture(scope="module")
def library():
    with open(byte_bpe.default_tokenizer(), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.default_tokenizer())


def test_ids_are_the_library_s(codec, library):
    rng = random.Random(11)
    kinds = [lambda: rng.randrange(32, 127), lambda: rng.randrange(32, 0x250), lambda: rng.randrange(0xD800), lambda: rng.randrange(0xE000, 0x110000)]
    texts = [text or "" for _, text in TEXTS]
    texts += ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randrange(60))) for _ in range(1500)]
    # runs of letters: many merges that depend on each other
    texts += ["".join(rng.choices(letters, k=k)) for letters in ("aeinot", "abcdefghijklmnopqrstuvwxyz", "ACGT", "ab", " \n") for k in (65, 90, 300, 2000)]
    texts += ["".join(rng.choices(["the", "he", "er", "in", "ing", "tion", "a"], k=200)) for _ in range(20)]
    found = list(codec.encode(texts))
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == library.encode_ordinary(text), text[:50]
    assert list(codec.decode(found)) == [text.encode() for text in texts]


def test_a_small_store_of_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_WORDS", 50)
    monkeypatch.setattr(byte_bpe, "SLICE_WORDS", 40)
    monkeypatch.setattr(byte_bpe, "SLICE_BYTES", 400)
    monkeypatch.setattr(byte_bpe, "DECODED_BITS", 3)
    monkeypatch.setattr(byte_bpe, "DECODED_IDS", 30)
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(byte_bpe, "QUERY_TOKENS", 64)
    codec = byte_bpe.Codec(byte_bpe.default_tokenizer())
    texts = [" ".join(f"word{i % 37} other{i % 11}" for i in range(n)) for n in (0, 5, 90, 300)]
    for _ in range(2):
        found = list(codec.encode(texts))
        assert [ids.tolist() for ids in found] == [library.encode_ordinary(text) for text in texts]
        assert list(codec.decode(found)) == [text.encode() for text in texts]


def test_query_and_round_trip(spark, documents, as_table, library):
    docs = documents(*TEXTS).selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS _x")
    found = queries.QUERIES["op11_byte_bpe"](spark, as_table(documents=docs)).collect()
    wanted = []
    for doc_id, text in TEXTS:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        digests = [hashlib.sha256(raw).hexdigest() for raw in (ids.tobytes(), (text or "").encode())]
        wanted.append((doc_id, len(ids), *digests))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    apart = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in apart) == sorted((str(i), (t or "").encode()) for i, t in TEXTS)


def test_edges(spark, documents):
    assert byte_bpe.encode(documents().limit(0), decoded=True).count() == 0
    ids = spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"\x00\x00\x00\x00"))], "doc_id long, ids binary")
    assert [bytes(r.decoded) for r in byte_bpe.decode(ids).orderBy("doc_id").collect()] == [b"", b"", b"!"]
    outside = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x7f"))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="isn't in the vocabulary"):
        byte_bpe.decode(outside).collect()
