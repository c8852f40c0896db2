"""Sharding by a Hilbert curve over metadata, for file pruning on several columns.

Each dimension is quantised to ``2**bits`` levels that hold about equally many
rows; a row's levels are a cell of a grid, and a Hilbert curve through the grid
orders the cells so that neighbours on the curve are neighbours in all
dimensions.  The ordered rows are cut into runs of equal length: the shards.  A
filter on any of the dimensions then touches few shards.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import hash32
from claimweave.llm.ranks import with_position

CATEGORY_BUCKETS = 4096


class Dimension(NamedTuple):
    column: str
    kind: str  # "category" or "number"


DOCUMENT_DIMENSIONS = (
    Dimension("source", "category"),
    Dimension("lang", "category"),
    Dimension("n_chars", "number"),
)


def bucket(dimension: Dimension) -> Column:
    """A bounded number of buckets: hashed categories, or numbers on a scale of 16
    steps for each power of two.  NULL is bucket -1, negative numbers count as 0."""
    value = F.col(dimension.column)
    if dimension.kind == "category":
        found = F.pmod(hash32(value), F.lit(CATEGORY_BUCKETS))
    else:
        number = F.greatest(value.cast("long"), F.lit(0).cast("long"))
        power = F.length(F.bin(number)) - 1
        # the four bits below the leading one
        step = F.floor(number / F.pow(F.lit(2.0), power - 4)).cast("long") - 16
        found = F.when(number < 16, number).otherwise(power * 16 + step)
    return F.when(value.isNull(), -1).otherwise(found).cast("long")


def curve_index(axes: Sequence[str], bits: int) -> Column:
    """The Hilbert index of grid coordinates by Skilling's transform (AIP Conf. Proc.
    707, 2004): from the highest bit down, each axis in turn inverts or swaps the lower
    bits of the axes; then comes a Gray code, whose bits are interleaved."""
    n = len(axes)
    start = ", ".join(f"CAST({axis} AS bigint)" for axis in axes)
    down = range(bits - 1, 0, -1)
    turns = ", ".join(
        f"struct({axis} AS axis, {q} AS q, {(1 << q) - 1}L AS low)" for q in down for axis in range(n)
    )
    undone = f"""aggregate(array({turns}), array({start}), (x, t) -> transform(x, (v, j) ->
        v ^ if(shiftright(x[t.axis], t.q) & 1 = 1,
            if(j = 0, t.low, 0L),
            if(j = 0 OR j = t.axis, (x[0] ^ x[t.axis]) & t.low, 0L))))"""
    gray = "transform(x, (v, j) -> aggregate(slice(x, 1, j + 1), 0L, (a, b) -> a ^ b))"
    lows = ", ".join(f"struct({q} AS q, {(1 << q) - 1}L AS low)" for q in down)
    turned = f"""aggregate(array({lows}), 0L,
        (a, t) -> a ^ if(shiftright(x[{n - 1}], t.q) & 1 = 1, t.low, 0L))"""
    places = ", ".join(
        f"struct({axis} AS axis, {q} AS q)" for q in (*down, 0) for axis in range(n)
    )
    index = f"aggregate(array({places}), 0L, (a, t) -> a * 2 + (shiftright(x[t.axis], t.q) & 1))"

    # each step names what it got x, so that no expression is repeated
    def let(value: str, then: str) -> str:
        return f"transform(array({value}), x -> {then})[0]"

    return F.expr(
        f"coalesce({let(undone, let(gray, let(f'transform(x, v -> v ^ {turned})', index)))}, 0L)"
    )


def hilbert_shards(
    df: DataFrame,
    key: str = "doc_id",
    tie_break: tuple[str, ...] = (),
    dimensions: tuple[Dimension, ...] = DOCUMENT_DIMENSIONS,
    shards: int = 40,
    bits: int = 5,
) -> DataFrame:
    """The rows of ``df`` with ``shard``, ``slot`` (position in the shard, from 0)
    and ``curve`` (the cell's Hilbert index).

    Shards differ by one row at most.  Within a cell rows are ordered by a hash of
    ``key``, then by ``key`` and ``tie_break``; equal rows take neighbouring slots in
    any order.  Rows without a key or with NULL dimensions are placed like others; an
    empty table gives an empty result.  Columns named like the three new ones, or
    starting with ``_``, must not be in ``df``.
    """
    rows = df.select(F.lit(1)).count()
    axes = [f"_x{i}" for i in range(len(dimensions))]
    raw = df.withColumns({axis: bucket(d) for axis, d in zip(axes, dimensions)})
    pairs = F.explode(
        F.array(*[F.struct(F.lit(a).alias("_axis"), F.col(a).alias("_raw")) for a in axes])
    )
    # at most CATEGORY_BUCKETS + 1 or 64 * 16 + 1 rows for each axis
    histogram = raw.select(pairs.alias("_p")).groupBy("_p._axis", "_p._raw").count()
    histogram = histogram.selectExpr(
        "_axis", "_raw",
        f"(coalesce(sum(count) OVER (PARTITION BY _axis ORDER BY _raw ROWS BETWEEN"
        f" UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {1 << bits}) div {max(rows, 1)} AS _level",
    )
    placed = raw
    for axis in axes:
        levels = histogram.where(F.col("_axis") == axis).select(
            F.col("_raw").alias(axis), F.col("_level").alias(f"{axis}_level")
        )
        placed = placed.join(F.broadcast(levels), axis)
    placed = placed.select(*df.columns, *[F.col(f"{a}_level").alias(a) for a in axes])
    ordered = with_position(
        placed.select(*df.columns, curve_index(axes, bits).alias("curve")),
        "curve", bits * len(axes), hash32(F.col(key)),
        [F.col(key), *map(F.col, tie_break)], rows,
    )
    shard = f"(_position * {shards}) div {max(rows, 1)}"
    first = f"(CAST(shard AS long) * {rows} + {shards - 1}) div {shards}"
    return ordered.withColumn("shard", F.expr(f"CAST({shard} AS int)")).selectExpr(
        *df.columns, "curve", "shard", f"_position - {first} AS slot"
    )


def write_shards(df: DataFrame, folder: str, **options) -> None:
    """Write the rows of ``hilbert_shards(df, **options)`` as one folder for each shard."""
    placed = hilbert_shards(df, **options)
    (
        placed.repartition("shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(folder)
    )
