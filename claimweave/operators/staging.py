"""Raw text tables to typed staging tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from claimweave.functions.casts import apply_layout, safe_to_int
from claimweave.operators.keys import first_per_key, least_per_key
from claimweave.sources.layouts import (
    BENEFICIARY,
    PDE,
    Field,
    Layout,
    header_fields,
    line_fields,
    line_key,
    names,
)


def stage_snapshots(*raw: DataFrame, layout: Layout = BENEFICIARY) -> DataFrame:
    """Yearly person snapshots as one typed table, told apart by their year."""
    together = reduce(DataFrame.unionByName, raw)
    return apply_layout(together, layout, {"bene_enrollmt_ref_yr": "enrollmt_ref_yr"})


def split_header(
    raw: DataFrame, layout: Layout, key: str = "clm_id", widen: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One typed row per claim, taken from its lowest line.

    Rows are reduced while still text, so each claim is cast once and not once
    per line.  With ``widen``, ``raw`` is a narrow table that has at least the claim and
    the line number, and ``widen`` makes the layout's columns, row by row; it is applied
    to the lowest lines alone.  The rows are those of ``split_header(widen(raw), ...)``.
    """
    fields = header_fields(layout)
    line = line_key(layout)
    if widen:
        one_each = least_per_key(raw, key, safe_to_int(line), lambda rows: widen(rows).select(*names(fields), line))
    else:
        one_each = first_per_key(raw.select(*names(fields), line), [key], [safe_to_int(line).asc_nulls_last()])
    return apply_layout(one_each, fields)


def split_line(raw: DataFrame, layout: Layout, key: str = "clm_id") -> DataFrame:
    """One typed row per claim line; the line number is called ``line_num``."""
    fields = (Field(key, "T"), *line_fields(layout))
    return apply_layout(raw, fields, {line_key(layout): "line_num"})


def stage_pde(raw: DataFrame, layout: Layout = PDE) -> DataFrame:
    """Prescription drug events, already one row per event."""
    return apply_layout(raw, layout)
