import random

import numpy as np
import pytest

from claimweave.llm import jaccard, queries
from claimweave.llm.shingles import shingle_sets


def brute_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [(i, brute_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            if s and t and i is not None and j is not None:
                both = len(s & t)
                if 100 * both >= 75 * (len(s) + len(t) - both):
                    low, high = sorted((find(i), find(j)))
                    parent[high] = low
    return sorted((i, len(s), find(i)) for i, s in sets if i is not None)


def corpus(seed, docs=220, passage=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = [rng.choices(vocabulary, k=passage) for _ in range(2)]
    made = []
    for i in range(docs):
        if made and rng.random() < 0.5:
            words = rng.choice(made).copy()
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([0, 2, 4, 5, 9, 30, 120, 300]))
            if rng.random() < 0.5:
                at = rng.randrange(len(words) + 1)
                words[at:at] = rng.choice(shared)
        made.append(words)
    return [(i * 3 + 1, "\t ".join(w).title() if i % 5 else " ".join(w)) for i, w in enumerate(made)]


@pytest.mark.parametrize("seed, common, block, leaf", [(1, 64, 1024, 48), (2, 8, 16, 4)])
def test_equals_brute_force(spark, documents, as_table, monkeypatch, seed, common, block, leaf):
    for name, value in (("COMMON_FROM", common), ("BLOCK", block), ("LEAF", leaf)):
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(seed) + [(9000, None), (9001, ""), (9002, " \n\t\x0b"), (9004, "w1 w2"), (9003, "W1\nw2")]
    rows += [rows[7], (None, rows[7][1]), (None, "nobody has this text at all")]
    found = queries.QUERIES["op2_jaccard"](spark, as_table(documents=documents(*rows))).collect()
    assert len(found) == len(rows)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None)
    assert got == brute([r for r in rows if r[0] is not None])
    nameless = sorted((r.n_shingles, r.component_id) for r in found if r.doc_id is None and r.n_shingles == 2)
    assert nameless == [(2, None)]


def test_one_doc_id_with_several_texts(spark, documents):
    rng = random.Random(7)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(900)], k=60)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts[:6])]
    rows += [(20, texts[6]), (20, texts[7]), (20, texts[8]), (20, ""), (21, texts[6] + " x"), (22, texts[7] + " y"), (23, texts[8])]
    rows += [(30, texts[9]), (30, texts[0] + " z"), (31, texts[9] + " z"), (31, texts[10]), (32, texts[10] + " q"), (33, texts[11])]
    found = jaccard.jaccard_components(documents(*rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def test_very_long_text_is_hashed_whole():
    text = "".join(f"word{i} " for i in range(700_000)) + "x" * 5_000_000 + " tail of the text"
    (whole,) = shingle_sets([text])
    assert len(whole) == len(text.split()) - 4
    first, second = shingle_sets(["a b c d e f g", "A  b\nc D e f h"])
    assert len(np.intersect1d(first, second)) == 2


def test_empty_table(spark, documents):
    assert jaccard.jaccard_components(documents().limit(0)).count() == 0


def test_region_join_links_all_that_brute_force_links():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**62, 200, dtype=np.uint64)
    sets = []
    for _ in range(300):
        kept = base[rng.random(200) < rng.choice([0.75, 0.85, 0.95])]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**62, rng.integers(0, 30), dtype=np.uint64)])))
    found = jaccard.RegionJoin(sets, np.arange(300)).join(np.arange(300))
    root = list(range(300))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in found:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)
        root[find(a)] = find(b)
    for a in range(300):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                assert find(a) == find(b)
    assert len(found) < 300
