import numpy as np
import pytest

from claimweave.llm import blocks, exact_topk, posting_ann, queries


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


ODD = [
    (90_000, None, 1), (90_020, [], 1), (90_200, [0.0] * 8, 1), (90_060, [1.0, None] * 4, 1),
    (90_080, [float("nan")] + [1.0] * 7, 1), (90_100, [float("inf")] + [1.0] * 7, 1), (None, [1.0] * 8, 1),
]


def vectors(n, seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    made = centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, 8))
    made[:copies] = made[0]
    return made.astype(np.float32)


def nearest(made, query, k, score):
    scores = score(made[query], made)
    others = [i for i in range(len(made)) if i != query]
    return sorted(others, key=lambda i: (-scores[i], i))[:k], scores


def test_exact_search_equals_brute_force(spark, as_table, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 100)
    monkeypatch.setattr(blocks, "BLOCK_QUERIES", 3)
    made = vectors(600, 1, copies=120)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(made)] + ODD + [(7, made[7].tolist(), 0)]
    found = queries.QUERIES["op6_topk"](spark, as_table(embeddings=table(spark, rows))).collect()
    ints = np.floor(256 * made.astype(np.float64)).astype(np.int64)
    for query in range(0, 600, 50):
        wanted, scores = nearest(ints, query, 5, lambda q, w: w @ q)
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        assert got == [(n, i, scores[i]) for n, i in enumerate(wanted, 1)]
    assert {r.query_id for r in found} == {*range(0, 600, 50), 90_200}


def test_term_at_a_time_keeps_large_numbers_and_skips_zeros():
    rng = np.random.default_rng(2)
    q = rng.integers(-(2**28), 2**28, (20, 30)) * (rng.random((20, 30)) < 0.2)
    w = rng.integers(-(2**28), 2**28, (50, 30))
    assert (exact_topk.accumulate(q, w) == q @ w.T).all()
    assert (exact_topk.accumulate(q % 9, w % 9) == (q % 9) @ (w % 9).T).all()


@pytest.mark.parametrize("copies", [0, 700])
def test_approximate_search_finds_nine_of_ten(spark, as_table, monkeypatch, copies):
    monkeypatch.setattr(posting_ann, "LIST_ROWS", 40)
    monkeypatch.setattr(posting_ann, "LEAST_PROBES", 4)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 200)
    made = vectors(2000, 3, copies)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(made)] + ODD
    found = queries.QUERIES["op4_ann"](spark, as_table(embeddings=table(spark, rows))).collect()
    exact = made.astype(np.float64)
    hits = total = 0
    for query in range(0, 2000, 20):
        _, scores = nearest(exact, query, 20, lambda q, w: w @ q)
        least = np.sort(np.delete(scores, query))[-20]
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        assert len(got) == 20 and query not in [i for _, i, _ in got]
        assert all(s == pytest.approx(scores[i], abs=1e-12) for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hits += sum(s >= least - 1e-9 for _, _, s in got)
        total += 20
    assert hits / total >= 0.9
    assert not {r.vec_id for r in found} & {i for i, _, _ in ODD}


def test_graph_search_finds_the_nearest_centroids():
    made = vectors(3000, 4)
    graph = posting_ann.CentroidGraph(posting_ann.balanced_centroids(made, 300))
    found, dist = graph.search(made[:500])
    true = posting_ann.distances(made[:500], graph.centroids)
    assert (found[:, 0] == true.argmin(1)).mean() > 0.98
    assert (np.diff(dist, axis=1) >= -1e-4).all()


def test_every_list_within_the_ratio_is_visited(monkeypatch):
    monkeypatch.setattr(posting_ann, "BEAM", 16)
    made = vectors(3000, 5)
    graph = posting_ann.CentroidGraph(posting_ann.balanced_centroids(made, 300))
    true = posting_ann.distances(made[:600], graph.centroids)
    for ratio in (1.18, 3.0):
        pairs = set(zip(*(x.tolist() for x in posting_ann.probes_of(graph, made[:600], ratio))))
        wanted = set(zip(*(x.tolist() for x in np.nonzero(true <= ratio * true.min(1, keepdims=True)))))
        assert len(wanted - pairs) < 0.01 * len(wanted)


def test_ratio_is_fitted_to_recall_of_vectors_in_random_directions(spark, monkeypatch):
    monkeypatch.setattr(posting_ann, "LIST_ROWS", 15)
    made = np.random.default_rng(6).normal(size=(3000, 32)).astype(np.float32)
    rows = table(spark, [(i, v.tolist(), 0) for i, v in enumerate(made)]).select("vec_id", "embedding")
    found = posting_ann.search(rows.where("vec_id % 20 = 0"), rows, 20).collect()
    exact = made.astype(np.float64)
    hits = 0
    for query in range(0, 3000, 20):
        wanted, _ = nearest(exact, query, 20, lambda q, w: w @ q)
        hits += len({r.vec_id for r in found if r.query_id == query} & set(wanted))
    assert hits / (150 * 20) >= 0.97


def test_few_and_no_vectors(spark, as_table):
    one = table(spark, [(0, [1.0, 2.0], 0), (20, [1.0], 0)])
    folder = as_table(embeddings=one)
    assert sorted((r.query_id, r.vec_id, r.score) for r in queries.QUERIES["op4_ann"](spark, folder).collect()) == [(0, 20, 1.0), (20, 0, 1.0)]
    empty = one.limit(0)
    assert posting_ann.search(empty, empty).count() == 0
    assert exact_topk.search(exact_topk.integer_weights(empty), exact_topk.integer_weights(empty)).count() == 0
