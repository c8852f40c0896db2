"""One row per key: the first, the latest, the deduplicated."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Filtering on ``row_number() = 1`` lets Spark keep one row per key already
    inside each map task, so a key that owns a third of the rows sends one row
    per task through the shuffle.  A hash over the whole row breaks ties: a task
    that is run again picks the same row.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*df.columns))
    return df.withColumn("_nth", F.row_number().over(ranked)).where("_nth = 1").drop("_nth")


def least_per_key(df: DataFrame, key: str, by: Column, widen: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The row of every key with the least ``by`` (NULL last), widened; the same rows as
    ``first_per_key`` over ``widen(df)``, but ``df`` is read three times.

    ``widen`` makes a wide row of each row by itself and keeps ``key``.  ``key`` and ``by``
    alone tell the least value of each key, so only rows that have it are widened.  Where
    several have it, a hash over the whole wide row decides between them.
    """
    values = df.select(F.col(key).alias("_key"), by.alias("_by")).groupBy("_key", "_by").agg(F.count(F.lit(1)).alias("_n"))
    least = values.groupBy("_key").agg(F.min(F.struct(F.col("_by").isNull(), "_by", "_n")).alias("_least"))
    least = least.select("_key", "_least._by", "_least._n")

    def kept(which: str) -> DataFrame:
        chosen = least.where(which)
        same = df[key].eqNullSafe(chosen["_key"]) & by.eqNullSafe(chosen["_by"])
        return widen(df.join(chosen, same, "left_semi"))

    tied = kept("_n > 1")
    columns = tied.columns
    first = tied.groupBy(key).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_row"))
    return kept("_n = 1").unionByName(first.select("_row.*"))


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The row with the highest ``by``; a missing ``by`` counts as highest."""
    return first_per_key(df, keys, [F.col(by).desc_nulls_first()])


def dedupe_first(df: DataFrame, key: str, position: str) -> DataFrame:
    """Keep the row of each key that comes first by ``position``."""
    return first_per_key(df, [key], [F.col(position).asc_nulls_last()])
