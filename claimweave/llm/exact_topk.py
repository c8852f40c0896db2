"""Exact top-k search by exhaustive term-at-a-time accumulation.

Each dimension is a term.  A query row scatters its weight of a term, times the
term's postings, into a dense array of scores; after all terms the best of each block
are selected, and the blocks' winners merged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.blocks import top_k, usable


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, one term after the other, in 32 bits where no sum of
    terms can overflow them."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    dtype = np.int32 if bound < 2**31 else np.int64
    scores = np.zeros((len(queries), len(rows)), dtype)
    weights, postings = queries.astype(dtype), np.ascontiguousarray(rows.T.astype(dtype))
    for term, posting in enumerate(postings):
        scattered = np.flatnonzero(weights[:, term])
        if len(scattered) == len(weights):
            scores += weights[:, term, None] * posting
        elif len(scattered):
            scores[scattered] += weights[scattered, term, None] * posting
    return scores.astype(np.int64)


def integer_weights(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """vec_id and its vector of floor(factor * x), for the vectors that take part."""
    weight = f"CAST(floor({factor} * CAST(x AS double)) AS bigint)"
    return vectors.where(usable("embedding", zero=True) & F.col("vec_id").isNotNull()).selectExpr(
        "vec_id", f"transform(embedding, x -> {weight}) AS vector"
    )


def search(queries: DataFrame, rows: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` best rows.

    Both sides have vec_id and vector (integers).  A query isn't compared with rows of
    its own vec_id; ties go to the smaller vec_id.  Of queries with one vec_id the
    least vector counts, of rows with one vec_id the best.  Short vectors end in
    zeros.  Scores must fit 64 bits.  An empty side gives an empty result.
    """
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return top_k(
        asked.select(F.lit(0).alias("list"), F.col("vec_id").alias("query_id"), "vector"),
        rows.select(F.lit(0).alias("list"), "vec_id", "vector"),
        accumulate, np.int64, "long", k,
    )
