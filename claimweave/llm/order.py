"""Rows in order, and their places in their groups, without a task for each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import broadcast_if_small, written


def in_order(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The rows, written in the order of ``order`` (NULL first), with ``_row``: the part
    of the order in its upper bits, the place in the part in its lower 33.

    Parts are ranges of the whole order, so a large group is spread over many of them.
    ``df`` is read twice, once for the bounds of the ranges, so it should be a table.
    Rows that are equal in ``order`` come in any order, and in one part."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.withColumn("_row", F.monotonically_increasing_id()), name)


def with_places(df: DataFrame, group: str) -> DataFrame:
    """Add ``position``, from 0 in the row's group, and ``total``, the group's rows, to
    rows of ``in_order`` by the group (not NULL) and more.  What is summed up across
    parts is a row for each part and group."""
    parts = df.withColumn("_part", F.shiftright("_row", 33))
    counts = parts.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_part", "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"),
        F.sum("_n").over(Window.partitionBy(group)).alias("total"),
    )
    joined = parts.join(broadcast_if_small(written(starts, "starts")), [group, "_part"])
    return joined.withColumn("position", F.col("_earlier") + F.col("_row") - F.col("_first")).drop(
        "_part", "_first", "_earlier", "_row"
    )
