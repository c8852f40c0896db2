"""Registered queries against their SQL twins, and the pipeline against brute force."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from claimweave.llm import jaccard, mixing, packing, pii, queries

from .test_hilbert_mixing import filled
from .test_jaccard import brute
from .test_text_operators import brute_spans

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_all_are_registered():
    names = entry_points.queries().keys()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert names >= {*queries.QUERIES, "pipeline"} and entry_points.oracle_sql().keys() >= queries.SQL.keys()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "PII", "mixing sources to target weights", "packing"
    ]


@pytest.mark.parametrize("name", queries.SQL)
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    wanted = connection.execute(queries.SQL[name])
    columns = [c[0] for c in wanted.description]
    found = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, found.select(*columns).collect()))) == sorted(map(str, wanted.fetchall()))


@pytest.mark.parametrize("name", ["op1_hilbert", "op7_secrets", "op10_mixing"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert word not in plan


def corpus(rng):
    words = {"en": "the of and house water light people under".split(), "fr": "été là où garçon élève forêt être déjà".split()}
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "fr"])
        text = " ".join(rng.choices([w + s for w in words[lang] for s in ("", "s", "e", "on")], k=rng.choice([3, 40, 200])))
        if rng.random() < 0.3:
            text += f" write to {rng.choice('abc')}{i}@mail.example.org or +1 (743) 555-{rng.randint(1000, 9999)} ."
        rows.append((i, text, lang, f"s{i % 4}"))
        if rng.random() < 0.2:
            rows.append((1000 + i, text.title() if lang == "en" else text, lang, "copies"))
    return rows + [(5000, None, "en", "s1"), (5001, "", "fr", None), (5002, "12 34 !", "en", "s2"), rows[10], rows[10]]


def test_pipeline_equals_brute_force(spark, documents, as_table, monkeypatch):
    rows = corpus(random.Random(12))
    folder = as_table(documents=documents(*rows))
    found = defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        found[r.sequence_id] = r
    assert sorted(found) == list(range(len(found)))

    kept = {i: (text, source) for i, text, _, source in rows if any(c.isalpha() for c in text or "")}
    leaders = {i for i, _, part in brute([(i, text) for i, (text, _) in kept.items()]) if i == part}
    masked = {i: (pii.mask(text, [pii.Span(*s) for s in brute_spans(text)]), source) for i, (text, source) in kept.items() if i in leaders}
    sizes = defaultdict(int)
    for text, source in masked.values():
        sizes[source] += len(text.split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = filled(sizes, {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)})
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    wanted = Counter()
    for i, (text, source) in masked.items():
        rate = target[source] / sizes[source]
        draw = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / 2**52
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
        start = 0
        for length in packing.piece_lengths(len(ids)):
            wanted[i, start, tuple(ids[start : start + length])] += int(rate) + (draw < rate % 1)
            start += length
    assert Counter((r.doc_id, r.start, tuple(r.ids)) for r in found.values()) == +wanted


def test_another_text_of_a_doc_id_stays(spark, documents):
    rng = random.Random(13)
    a, b, c, d = (" ".join(rng.choices([f"w{i}" for i in range(900)], k=60)) for _ in range(4))
    rows = [(1, a), (5, a + " x"), (5, b), (5, b), (5, c), (6, c + " x"), (7, d), (8, d), (5, ""), (None, a)]
    kept = corpus_pipeline.drop_near_copies(spark, documents(*rows), "").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, a), (5, b), (5, c), (7, d), (5, ""), (None, a)])


def test_stages_on_an_empty_table(spark, documents, as_table):
    empty = documents().limit(0)
    folder = as_table(documents=empty)
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages_return_the_columns_of_documents(spark, documents):
    docs = documents((1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"), (None, None, None, None))
    docs = docs.selectExpr("*", "1 AS n", "2 AS key", "3 AS lang_pred2", "4 AS _x")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
    assert corpus_pipeline.drop_near_copies(spark, docs, "").count() == 2
    assert jaccard.jaccard_components(docs).count() == 3
