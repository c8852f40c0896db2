import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from claimweave.llm import packing, queries

TEXTS = [
    (1, "The quick, brown fox. It's DON'T we'll 'Sx 3.14 ½ 漢字 😀!? naïve ÉTÉ straße"), (2, None), (3, ""), (4, " \n\t"),
    (5, "<|endoftext|> Foo<|startoftext|>BAR <|ENDOFTEXT|>"), (6, "a\x1cb x\x85y z​w İSTANBUL ΣΑΣ é ŀ"),
    (7, "word " * 5000), (8, "".join(f"tok{i}, " for i in range(9000))), (1, "repeated id"), (None, "no id"), (9, "x" * 60_000),
]


def wanted(text):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_word_by_word_equals_whole_text():
    encode = packing.WordTokenizer(packing.default_tokenizer())
    texts = [text or "" for _, text in TEXTS] + [f"{chr(c)}a {chr(c)}{chr(c)} .{chr(c)}," for c in range(0x20, 0x2000, 5)]
    tokenizer = encode.tokenizer
    for _ in range(2):  # learned, then remembered
        for text, ids in zip(texts, encode(texts)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_few_known_words_and_equal_hashes_change_nothing(monkeypatch):
    wanted = packing.WordTokenizer(packing.default_tokenizer()).tokenizer
    texts = [f"a{i % 7}. Word{i}, x.y. ...z. ,. 3.14, (b). 'c'. d!." for i in range(300)] + ["w" * 50 + " é. É, " * 200]
    for known, hashed in ((5, None), (3_000_000, 4)):
        encode = packing.WordTokenizer(packing.default_tokenizer())
        monkeypatch.setattr(packing, "KNOWN_WORDS", known)
        monkeypatch.setattr(packing, "SLICE_BYTES", 500)
        if hashed:
            spans = packing.word_spans
            monkeypatch.setattr(packing, "word_spans", lambda raw: (spans(raw)[0] % np.array([[hashed], [1 << 63]], np.uint64), *spans(raw)[1:]))
        for text, ids in zip(texts, encode(texts), strict=True):
            assert ids.tolist() == wanted.encode(text, add_special_tokens=False).ids


def test_pieces_round_trip(spark, documents, as_table):
    df = documents(*TEXTS)
    made = packing.pack(df, with_ids=True).collect()
    found = defaultdict(list)
    for r in made:
        assert r.length & (r.length - 1) == 0 and r.length <= packing.MAX_LENGTH and r.offset == 0
        assert len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        found[r.doc_id, r.doc_tokens].append((r.start, r.ids))
    whole = sorted((str(i), wanted(t)) for i, t in TEXTS)
    joined = []
    for (doc_id, tokens), parts in found.items():
        ids = [x for _, part in sorted(parts) for x in part]
        assert len(ids) == tokens and [s for s, _ in sorted(parts)] == np.cumsum([0, *[len(p) for _, p in sorted(parts)]])[:-1].tolist()
        joined.append((str(doc_id), ids))
    assert sorted(joined) == whole
    order = sorted(made, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in order] == list(range(len(made)))
    lengths = [r.length for r in order]
    assert lengths == sorted(lengths, reverse=True)
    thin = queries.QUERIES["op3_packing"](spark, as_table(documents=df)).collect()
    # which task makes a piece sets its number, and these rows are dealt to other tasks
    same = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset")
    assert sorted(str([r[c] for c in same]) for r in thin) == sorted(str([r[c] for c in same]) for r in made)
    assert sorted(r.sequence_id for r in thin) == list(range(len(made)))


def test_binary_lengths():
    assert packing.piece_lengths(2048 * 2 + 5) == [2048, 2048, 4, 1]
    assert packing.piece_lengths(1) == [1] and packing.piece_lengths(0) == []
    assert all(sum(packing.piece_lengths(n, 16)) == n for n in range(100))


def test_empty_table(spark, documents):
    assert packing.pack(documents().limit(0)).count() == 0


def test_stages_of_the_pipeline_hand_over_small_batches(spark, documents):
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        corpus_pipeline.mask_personal_data(spark, documents((1, "call +44 20 7946 0958")), "")
        assert int(spark.conf.get(name)) == 1000
        spark.conf.set(name, "200")
        corpus_pipeline.mask_personal_data(spark, documents((1, "call +44 20 7946 0958")), "")
        assert int(spark.conf.get(name)) == 200
    finally:
        spark.conf.set(name, before)
