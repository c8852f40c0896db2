"""Ratios that are rounded once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(part: Column, whole: Column, digits: int, scale: int = 0) -> Column:
    """``part / whole`` to ``digits`` decimals, half away from zero; NULL for no whole.

    ``part`` is a whole number or a decimal of ``scale`` digits, ``whole`` a count.  A
    decimal division would round to some digits first, so whole numbers are divided:
    the double of the shifted part plus one whole, by the double whole."""
    shift = max(digits, scale)
    units = (part * F.lit(10**shift)).cast("decimal(38,0)")
    size = F.nullif(whole, F.lit(0)).cast("decimal(20,0)") * F.lit(10 ** (shift - digits))
    size = size.cast("decimal(30,0)")
    twice = (F.abs(units) * 2).cast("decimal(38,0)") + size
    steps = F.call_function("div", twice, size * 2)
    signed = F.when(units < 0, -steps).otherwise(steps)
    return (signed / F.lit(10**digits).cast("decimal(10,0)")).cast(f"decimal(20,{digits})")
