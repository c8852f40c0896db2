"""Joins to a table that is unique per key, safe against hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 500
SALTS = 256
#: Sketches that are merged side by side before the last merge.
SKETCH_GROUPS = 64


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys that own more than one ``share``-th of the rows.

    A frequency sketch finds them in one pass over the key column, without a
    shuffle of the keys.  At most ``share`` keys can qualify, so the result is
    small whatever the data.  The map tasks' sketches are merged in groups first, so
    the last task reads ``SKETCH_GROUPS`` of them, however many tasks there are.  ``df``
    is read twice, here and in the join; a frame that is costly to make should be a
    stored table.
    """
    counters = 8 * share
    grouped = (
        df.selectExpr(f"`{key}` AS item", f"pmod(spark_partition_id(), {SKETCH_GROUPS}) AS part")
        .groupBy("part")
        .agg(
            F.expr(f"approx_top_k_accumulate(item, {counters}) AS sketch"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    # a key to group by, as a task without any sketch must not make an empty one
    counted = grouped.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {counters}), {share}) AS top"),
        F.sum("n").alias("total"),
    )
    return (
        counted.selectExpr("inline(top) AS (item, n)", "total")
        .where(f"item IS NOT NULL AND n * {share} > total")
        .selectExpr(f"item AS `{key}`", "true AS is_hot")
    )


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Sequence[str],
    how: str = "left",
    share: int = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Add ``columns`` of ``dim``, which is unique per ``key``, to ``df``.

    Rows of a hot key, and rows without a key, are spread over ``salts``
    partitions; the ``dim`` row of a hot key is repeated for each of them.  All
    other keys join as usual.  The sketch only decides where rows travel, the
    result does not depend on what it finds.
    """
    hot = F.broadcast(hot_keys(df, key, share))
    row = ", ".join(f"`{name}`" for name in df.columns)
    spread = df.join(hot, key, "left").selectExpr(
        *[f"`{name}`" for name in df.columns],
        f"if(is_hot OR `{key}` IS NULL, pmod(xxhash64({row}), {salts}), 0) AS _salt",
    )
    repeated = (
        dim.select(key, *columns)
        .join(hot, key, "left")
        .selectExpr(
            f"`{key}`",
            *[f"`{name}`" for name in columns],
            f"explode(if(is_hot, sequence(0L, {salts - 1}L), array(0L))) AS _salt",
        )
    )
    return spread.join(repeated, [key, "_salt"], how).select(*df.columns, *columns)
