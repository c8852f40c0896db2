"""Gapless global positions without a global sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one sorting task should get at most.
RUN_ROWS = 1 << 16


def with_position(
    df: DataFrame, group: str, group_bits: int, scatter: Column, order: Sequence[Column], rows: int
) -> DataFrame:
    """Add ``_position``: where a row stands, from 0, in the order of ``group``,
    then ``scatter``, then ``order``.

    ``group`` is a number below ``2**group_bits``, ``scatter`` a 32-bit hash.  The
    groups are cut into runs by the leading bits of the hash, so a group that owns
    a third of the rows is spread over many tasks; how many bits are used follows
    from ``rows`` and does not change any position.  Only the counts of the runs
    are summed up across tasks, in two steps of about the square root of their
    number each.  ``df`` is read twice, once for the counts.
    """
    run_bits = min(20, max(6, math.ceil(math.log2(max(rows, 1) / RUN_ROWS))))
    half = (group_bits + run_bits + 1) // 2
    runs = df.withColumn("_scatter", scatter).withColumn(
        "_run",
        F.shiftleft(F.col(group).cast("long"), run_bits)
        + F.shiftright("_scatter", 32 - run_bits),
    )
    counts = runs.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_coarse", F.shiftright("_run", half))
    coarse = counts.groupBy("_coarse").agg(F.sum("_n").alias("_all")).select(
        "_coarse",
        F.coalesce(F.sum("_all").over(Window.orderBy("_coarse").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"),
    )
    within = Window.partitionBy("_coarse").orderBy("_run").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        counts.withColumn("_inside", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(coarse, "_coarse")
        .select("_run", (F.col("_earlier") + F.col("_inside")).alias("_start"))
    )
    nth = F.row_number().over(Window.partitionBy("_run").orderBy("_scatter", *order))
    return (
        runs.withColumn("_nth", nth)
        .join(starts, "_run")
        .withColumn("_position", F.col("_start") + F.col("_nth") - 1)
        .select(*df.columns, "_position")
    )
