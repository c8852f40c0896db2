"""Scoring sets of queries against lists of rows in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import hash32

BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048
#: Scores that are held at once, 8 bytes each.
SCORES = 1 << 22


def usable(vector: str, zero: bool) -> Column:
    """True for vectors that take part: not NULL, and without NULL or non-finite
    components; ``zero`` says whether a vector without any other component may."""
    finite = f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    some = "true" if zero else f"exists({vector}, x -> x <> 0)"
    return F.expr(f"coalesce({vector} IS NOT NULL AND {finite} AND {some}, false)")


def matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """A list column as a matrix; short vectors end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def widened(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` highest scores of a row, highest first, ties to the smaller
    id.  ``ids`` rise.  Everything that ties with the k-th is looked at."""
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        found = np.flatnonzero(scores >= limit)
    else:
        found = np.arange(len(scores))
    return found[np.lexsort((ids[found], -scores[found]))][:k]


def top_k(
    queries: DataFrame,
    rows: DataFrame,
    score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    dtype,
    kind: str,
    k: int,
) -> DataFrame:
    """Each query's ``k`` best rows among the lists it visits, without its own id.

    ``queries`` has list, query_id and vector; ``rows`` has list, vec_id and vector.
    A list, or the queries of a list, beyond a block's size is dealt by a hash into
    several blocks, and every block of queries meets every block of rows of its list;
    so no task holds more than two blocks, whatever the size of a list.  ``score`` gives
    a matrix of scores of the SQL type ``kind``.  A row that a query meets in several
    lists counts once.
    """
    sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("_rows"))
    asked = queries.groupBy("list").agg(F.count(F.lit(1)).alias("_asked"))
    cuts = sizes.join(asked, "list").select(
        "list",
        F.ceil(F.col("_rows") / BLOCK_ROWS).cast("int").alias("_r"),
        F.ceil(F.col("_asked") / BLOCK_QUERIES).cast("int").alias("_q"),
    )
    row_blocks = rows.join(cuts, "list").select(
        "list", F.pmod(hash32(F.col("vec_id")), F.col("_r")).alias("_rb"),
        F.expr("explode(sequence(0L, _q - 1L)) AS _qb"), "vec_id", "vector",
    )
    query_blocks = queries.join(cuts, "list").select(
        "list", F.expr("explode(sequence(0L, _r - 1L)) AS _rb"),
        F.pmod(hash32(F.col("query_id")), F.col("_q")).alias("_qb"), "query_id", "vector",
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found_queries, found_rows, found_scores = [], [], []
        if left.num_rows and right.num_rows:
            ids = right["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            asked = left["query_id"].to_numpy()
            q, w = matrix(left["vector"], dtype), matrix(right["vector"], dtype)[order]
            width = max(q.shape[1], w.shape[1])
            q, w = widened(q, width), widened(w, width)
            step = max(1, SCORES // len(ids))
            for first in range(0, len(asked), step):
                table = score(q[first : first + step], w)
                for own, scores in zip(asked[first : first + step], table):
                    at, end = np.searchsorted(ids, [own, own + 1])
                    if end > at:
                        scores, others = np.delete(scores, slice(at, end)), np.delete(ids, slice(at, end))
                    else:
                        others = ids
                    chosen = best(scores, others, k)
                    found_queries.append(np.full(len(chosen), own))
                    found_rows.append(others[chosen])
                    found_scores.append(scores[chosen])
        def joined(parts, empty):
            return np.concatenate(parts) if parts else np.zeros(0, empty)

        return pa.table({
            "query_id": joined(found_queries, np.int64),
            "vec_id": joined(found_rows, np.int64),
            "score": joined(found_scores, dtype),
        })

    keys = ["list", "_rb", "_qb"]
    found = (
        query_blocks.groupBy(*keys)
        .cogroup(row_blocks.groupBy(*keys))
        .applyInArrow(search, f"query_id long, vec_id long, score {kind}")
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
