"""Session settings the jobs are written for."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SETTINGS = {
    # re-plan at run time: turn shuffled joins into broadcast ones when a side
    # proves small, split hot join partitions, merge small ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where an extra shuffle follows from it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a hierarchy of any size may be descended
    "spark.sql.cteRecursionRowLimit": "-1",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


SHUFFLE_PARTITION_MB = 256


def shuffle_partitions(shuffled_gb: float) -> int:
    """Partitions that keep a shuffle of this size at about 256 MB each.  Small
    steps of the same job are merged back by adaptive execution."""
    return max(200, math.ceil(shuffled_gb * 1024 / SHUFFLE_PARTITION_MB))


def build_session(
    name: str, master: str | None = None, shuffled_gb: float | None = None, **settings: str
) -> SparkSession:
    """A session with ``SETTINGS``; ``settings`` (dots written as ``__``) win.

    ``shuffled_gb`` is the size of the largest shuffle to expect, roughly the
    size of the largest claim extract."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffled_gb is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(shuffled_gb))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
