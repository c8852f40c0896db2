"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample and found by a search in an in-memory graph.
A vector goes into the list of its nearest centroid and, near a boundary, into lists
of others; a query visits the lists whose centroids are not much farther than the
nearest, how much is fitted to a target recall.  Largest inner products become least distances by one more dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.blocks import matrix, top_k, usable, widened
from claimweave.llm.common import unit, written

#: Vectors to fit centroids on, drawn by a hash of vec_id.
SAMPLE = 20_000
#: Vectors a list is meant to hold, and the most lists there are.
LIST_ROWS = 1600
MAX_LISTS = 4096
#: A vector is put into lists up to this many, with distances up to this ratio.
REPLICAS, REPLICA_RATIO = 4, 1.10
#: A query visits lists with distances up to this ratio, or a larger one where recall
#: needs it, and at least so many.
PROBE_RATIO, LEAST_PROBES = 1.18, 12
#: The recall that the ratio is fitted to, and queries it is fitted on, drawn by a hash.
TARGET_RECALL, FIT_QUERIES = 0.99, 256
NEIGHBOURS, BEAM = 24, 96


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """K-means on the sphere that all vectors lie on, in which a centroid's distance
    grows with the size of its cluster, so that clusters become alike in size."""
    rng = np.random.default_rng(7)
    radius = np.sqrt((sample * sample).sum(1).max())
    centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
    weight = np.ones(lists)
    for _ in range(rounds):
        near = np.concatenate([
            (distances(part, centroids) * weight).argmin(1)
            for part in np.array_split(sample, len(sample) // 4096 + 1)
        ])
        sizes = np.bincount(near, minlength=lists)
        weight *= np.clip(sizes * lists / len(sample), 0.25, 4) ** 0.05
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        spare = sample[rng.choice(len(sample), lists)]
        centroids = np.where(norms > 0, sums * (radius / np.maximum(norms, 1e-30)), spare).astype(sample.dtype)
    return centroids


class CentroidGraph:
    """Centroids, each linked to its nearest and to some at random; a beam search walks
    the links from a fixed set of entries."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        n = len(centroids)
        rng = np.random.default_rng(11)
        near = np.concatenate([
            distances(part, centroids).argsort(1)[:, 1 : 1 + NEIGHBOURS]
            for part in np.array_split(centroids, n // 1024 + 1)
        ])
        self.links = np.concatenate([near, rng.integers(0, n, (n, 4))], axis=1)
        self.entries = rng.choice(n, min(n, 32), replace=False)

    def search(self, vectors: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the nearest centroids found, nearest first, and distances."""
        found = [self._search(vectors[i : i + 512], beam) for i in range(0, len(vectors), 512)]
        return tuple(np.concatenate(parts) for parts in zip(*found))

    def _search(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, beam = len(self.centroids), min(beam, len(self.centroids))
        everyone = np.arange(len(vectors))[:, None]
        seen = np.zeros((len(vectors), n), bool)
        done = np.zeros((len(vectors), n), bool)
        dist = np.full((len(vectors), n), np.inf, np.float32)
        squares = (vectors * vectors).sum(1)[:, None]
        lengths = (self.centroids * self.centroids).sum(1)

        def look(ids: np.ndarray) -> None:
            dots = np.einsum("qd,qkd->qk", vectors, self.centroids[ids])
            dist[everyone, ids] = np.sqrt(np.maximum(squares + lengths[ids] - 2 * dots, 0))
            seen[everyone, ids] = True

        look(np.broadcast_to(self.entries, (len(vectors), len(self.entries))))
        while True:
            top = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
            open_ = np.where(done[everyone, top] | ~seen[everyone, top], np.inf, dist[everyone, top])
            best = open_.argmin(1)
            if np.isinf(open_[everyone[:, 0], best]).all():
                break
            # queries that are done look again at what they know
            step = top[everyone[:, 0], best]
            done[everyone[:, 0], step] = True
            look(self.links[step])
        order = np.take_along_axis(dist, top, 1).argsort(1)
        top = np.take_along_axis(top, order, 1)
        return top, np.take_along_axis(dist, top, 1)


def lists_of(graph: CentroidGraph, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of vector and list: the nearest list, and others within the ratio unless
    a list taken before is nearer to that centroid than the vector is."""
    found, dist = graph.search(vectors, max(16, REPLICAS))
    found, dist = found[:, :REPLICAS], dist[:, :REPLICAS]
    taken = np.zeros(found.shape, bool)
    taken[:, 0] = True
    for j in range(1, found.shape[1]):
        gap = np.linalg.norm(graph.centroids[found[:, j], None] - graph.centroids[found[:, :j]], axis=2)
        hidden = (taken[:, :j] & (gap < dist[:, j, None] * 0.8)).any(1)
        taken[:, j] = (dist[:, j] <= REPLICA_RATIO * dist[:, 0]) & ~hidden
    who, which = np.nonzero(taken)
    return who, found[who, which]


def probes_of(
    graph: CentroidGraph, vectors: np.ndarray, ratio: float = PROBE_RATIO
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of query and list to visit.  A query whose farthest list found is within
    the ratio is searched again with a wider beam, and in the end among all lists."""
    n, beam = len(graph.centroids), max(BEAM, LEAST_PROBES)
    rest, pairs = np.arange(len(vectors)), []
    while len(rest):
        whole = 4 * beam >= n  # the search would look at most of the lists
        own, left = rest, []
        for part in np.array_split(own, len(own) // 512 + 1):
            if whole:
                dist = distances(vectors[part], graph.centroids)
                found = dist.argsort(1, kind="stable")
                dist = np.take_along_axis(dist, found, 1)
            else:
                found, dist = graph.search(vectors[part], beam)
            ready = whole | (dist[:, -1] > ratio * dist[:, 0])
            near = dist <= ratio * dist[:, :1]
            near[:, :LEAST_PROBES] = np.isfinite(dist[:, :LEAST_PROBES])
            who, which = np.nonzero(near & np.reshape(ready, (-1, 1)))
            pairs.append((part[who], found[who, which]))
            left.append(part[:0] if whole else part[~ready])
        rest, beam = np.concatenate(left), 2 * beam
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(parts) for parts in zip(*pairs))


def neighbours(asked: pa.Table, rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id: the ``k`` nearest rows of the few vectors in ``asked``, by
    comparison with all rows.  A task gives at most ``k`` rows for each."""
    shared = rows.sparkSession.sparkContext.broadcast(
        (asked["vec_id"].to_numpy(), matrix(asked["embedding"], np.float64))
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        held = np.full((len(own), k), -np.inf)
        ids = np.zeros((len(own), k), np.int64)
        for batch in (whole.slice(i, 4096) for whole in batches for i in range(0, whole.num_rows, 4096)):
            w, others = matrix(batch.column(1), np.float64), batch.column(0).to_numpy()
            width = max(q.shape[1], w.shape[1])
            scores = widened(q, width) @ widened(w, width).T
            scores[own[:, None] == others] = -np.inf
            scores = np.concatenate([held, scores], axis=1)
            everyone = np.concatenate([ids, np.broadcast_to(others, (len(own), len(others)))], axis=1)
            top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            held, ids = np.take_along_axis(scores, top, 1), np.take_along_axis(everyone, top, 1)
        who, which = np.nonzero(np.isfinite(held))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[who]), pa.array(ids[who, which]), pa.array(held[who, which])], ["query_id", "vec_id", "score"]
        )

    found = rows.mapInArrow(find, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("_rank", rank).where(F.col("_rank") <= k).select("query_id", "vec_id")


def fitted_ratio(asked: DataFrame, rows: DataFrame, index: DataFrame, graph: CentroidGraph, width: int, k: int) -> float:
    """The ratio, at least PROBE_RATIO, with which the target share of the true
    neighbours of a sample of queries is in a list that is visited."""
    share = FIT_QUERIES / max(1, asked.count())
    drawn = asked.where(unit(F.lit("recall"), F.col("vec_id")) < share).limit(2 * FIT_QUERIES).toArrow()
    if not drawn.num_rows:
        drawn = asked.limit(FIT_QUERIES).toArrow()
    if not drawn.num_rows:
        return PROBE_RATIO
    # rows of at most two FIT_QUERIES times k neighbours
    true = F.broadcast(neighbours(drawn, rows, k))
    held = index.join(true, "vec_id").select("query_id", "vec_id", "list").distinct().toArrow()
    queries = widened(matrix(drawn["embedding"], np.float32), width)
    dist = distances(np.column_stack([queries, np.zeros(len(queries), np.float32)]), graph.centroids)
    ratio = dist / np.maximum(dist.min(1, keepdims=True), 1e-30)
    np.put_along_axis(ratio, dist.argsort(1, kind="stable")[:, :LEAST_PROBES], 0, 1)
    place = {own: i for i, own in enumerate(drawn["vec_id"].to_pylist())}
    needed: dict[tuple[int, int], float] = {}
    for query, row, at in zip(*(held[c].to_pylist() for c in ("query_id", "vec_id", "list"))):
        needed[query, row] = min(needed.get((query, row), np.inf), ratio[place[query], at])
    if not needed:
        return PROBE_RATIO
    # a little more, as distances are rounded
    return max(PROBE_RATIO, 1.0001 * float(np.quantile(list(needed.values()), TARGET_RECALL, method="higher")))


def _spread(vectors: DataFrame, graph, reach: float, pick, name: str) -> DataFrame:
    """``vectors`` (vec_id, embedding) once for each list that ``pick`` gives; ``reach``
    is the largest norm, up to which the added dimension fills a row."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = matrix(batch.column(1), np.float32)
            raw = widened(raw, graph.value.centroids.shape[1] - 1)
            square = (raw.astype(np.float64) ** 2).sum(1)
            filled = np.sqrt(np.maximum(reach * reach - square, 0))
            if name == "query_id":
                filled[:] = 0
            who, which = pick(graph.value, np.column_stack([raw, filled]).astype(np.float32))
            lists, rows = pa.array(which.astype(np.int32)), pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [lists, *(column.take(rows) for column in batch.columns)], ["list", name, "vector"]
            )

    return vectors.mapInArrow(assign, f"list int, {name} long, vector array<double>")


def search(queries: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score, the inner product in double precision
    of the given vectors, of each query's ``k`` nearest rows found.

    Both sides have vec_id and embedding.  Every row is indexed; vectors that are NULL,
    zero, or hold NULL or non-finite components take no part, nor do rows without a
    vec_id.  A query isn't compared with rows of its own vec_id; ties go to the smaller
    vec_id.  Of queries with one vec_id the least vector counts, of rows with one
    vec_id the best.  Lists are visited up to a distance that finds TARGET_RECALL of the
    true neighbours of a sample of queries.  Short vectors end in zeros.  A list that has grown beyond a
    block, as that of a vector with very many copies, is searched in several blocks.
    An empty side gives an empty result.
    """
    spark = rows.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        ok = usable("embedding", zero=False) & F.col("vec_id").isNotNull()
        return df.where(ok).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))

    rows, queries = clean(rows), clean(queries)
    asked = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    total, reach, width = rows.select(
        F.count(F.lit(1)),
        F.sqrt(F.max(F.expr("aggregate(embedding, 0D, (a, x) -> a + x * x)"))),
        F.max(F.size("embedding")),
    ).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = max(width, asked.select(F.max(F.size("embedding"))).first()[0] or 0)
    drawn = rows.where(unit(F.lit("fit"), F.col("vec_id")) < SAMPLE / total).limit(2 * SAMPLE).toArrow()
    if not drawn.num_rows:
        drawn = rows.limit(1).toArrow()
    sample = widened(matrix(drawn["embedding"], np.float64), width)
    filled = np.sqrt(np.maximum(reach * reach - (sample * sample).sum(1), 0))
    sample = np.column_stack([sample, filled]).astype(np.float32)
    lists = max(1, min(MAX_LISTS, total // LIST_ROWS, len(sample) // 4))
    graph = spark.sparkContext.broadcast(CentroidGraph(balanced_centroids(sample, lists)))
    index = written(_spread(rows, graph, reach, lists_of, "vec_id"), "posting-lists")
    asked = written(asked, "queries")
    ratio = fitted_ratio(asked, rows, index, graph.value, width, k)
    probes = written(_spread(asked, graph, reach, partial(probes_of, ratio=ratio), "query_id"), "probes")
    return top_k(probes, index, lambda q, w: q @ w.T, np.float64, "double", k)
