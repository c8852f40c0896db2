"""Casts from raw text that give NULL for bad input instead of failing.

All are built-in expressions, so they run inside generated code on the
executors and cost no Python worker.  They take column names and are kept as
SQL text: typing a 197-column extract is then one ``selectExpr`` and not
thousands of calls from Python into the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.sources.layouts import Field

_CLEAN = "nullif(trim({0}), '')"
_WHOLE = "try_cast(trim({0}) AS %s)"

CASTS: dict[str, str] = {
    "T": _CLEAN,
    "D": f"try_to_date({_CLEAN}, 'd-MMM-yyyy')",
    "I": _WHOLE % "int",
    "S": _WHOLE % "smallint",
    "N": _WHOLE % "decimal(15,2)",
    "Q": _WHOLE % "decimal(12,3)",
}


def _cast(kind: str, column: str) -> str:
    return CASTS[kind].format(f"`{column}`")


def clean_text(column: str) -> Column:
    """Text without surrounding blanks; NULL when nothing is left."""
    return F.expr(_cast("T", column))


def safe_to_date(column: str) -> Column:
    """Date written like ``16-Aug-1999``, in any letter case."""
    return F.expr(_cast("D", column))


def safe_to_numeric(column: str) -> Column:
    """Amount with two decimals; too many digits give NULL, extra decimals are
    rounded."""
    return F.expr(_cast("N", column))


def safe_to_int(column: str) -> Column:
    """Whole number; ``1.5`` is NULL."""
    return F.expr(_cast("I", column))


def apply_layout(
    df: DataFrame,
    layout: Iterable[Field],
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Type a text frame: one projection holding the cast of every field."""
    rename = rename or {}
    return df.selectExpr(
        *[f"{_cast(f.kind, f.name)} AS `{rename.get(f.name, f.name)}`" for f in layout]
    )
