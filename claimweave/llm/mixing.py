"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import WORD, broadcast_if_small, unit, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"


def words(text: Column) -> Column:
    """Number of words of a text, 0 for none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight`` to a table of one row for each ``source``: the given weights in
    turn over the sources by code point, NULL last."""
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*map(F.lit, weights))
    return sources.withColumn("weight", turn[F.pmod(nth, F.lit(len(weights)))].cast("long"))


def targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target`` to rows of ``source``, ``source_size`` and ``weight``.

    The sum of all sizes is shared by weight.  A source gets at most ``max_repeats``
    times its size, and what it can't take goes to the others by weight: with the
    sources ordered by the share at which they are full, the first ``k`` are full and
    the others get ``weight`` times a common rate.  ``k`` is the first for which no
    other is above its limit.  A weight is above 0.
    """
    # one row for each source, so the windows sort a small table
    by_fill = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    earlier = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sources.withColumn("_limit", F.col("source_size") * max_repeats)
    ranked = ranked.select(
        "*",
        (
            (F.sum("source_size").over(every) - F.coalesce(F.sum("_limit").over(earlier), F.lit(0)))
            / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        ).alias("_rate"),
    )
    fits = F.col("_rate") * F.col("weight") <= F.col("_limit")
    # the first that fits, in the order of filling up
    first = F.struct(F.when(fits, 0).otherwise(1), F.col("_limit") / F.col("weight"), "_rate")
    rated = ranked.withColumn("_common", F.min(first).over(every)["_rate"])
    target = F.when(
        F.col("_limit") < F.col("_common") * F.col("weight"), F.col("_limit")
    ).otherwise(F.col("_common") * F.col("weight"))
    return rated.withColumn("target", target.cast("double")).drop("_limit", "_rate", "_common")


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    size: Column | None = None,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` of the source and
    ``_copies``, how often the mix takes the document.

    A document is taken floor(rate) times, and once more if a number drawn by a hash
    of seed and doc_id is below the rate's fraction; rate is target by size of its
    source.  So a rerun takes the same documents, whatever the partitions.  Rows with
    one doc_id share their draw.  A NULL source is a source; a NULL text has size 0; a
    source of size 0 gives nothing.  ``weights`` (source, weight) replaces the cyclic
    weights; a source that it lacks is left out of the mix.  Other columns pass.
    """
    sized = docs.withColumn("_size", words(F.col("text")) if size is None else size)
    sources = sized.groupBy("source").agg(F.sum("_size").alias("source_size"))
    found = written(sources, "mix-sources")
    if weights is None:
        weighed = cyclic_weights(found)
    else:
        same = F.col("s.source").eqNullSafe(F.col("w.source"))
        weighed = found.alias("s").join(weights.alias("w"), same).select("s.*", "w.weight")
    shares = written(targets(weighed, max_repeats), "mix-targets").select(
        F.col("source").alias("_source"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
    )
    same = F.col("source").eqNullSafe(F.col("_source"))
    joined = sized.join(broadcast_if_small(shares), same).drop("_source")
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = unit(F.lit(seed), F.col("doc_id")) < rate - whole
    return joined.withColumn("_copies", (whole + extra.cast("long")).cast("long"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document of ``mix`` as often as the mix takes it."""
    names = [c for c in mixed.columns if c not in ("_size", "_source_size", "_target", "_copies")]
    return mixed.where("_copies > 0").select(
        *names, F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_copy")
    ).drop("_copy")
