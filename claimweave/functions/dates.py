"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key_sql(day: str) -> str:
    return f"year({day}) * 10000 + month({day}) * 100 + day({day})"


def date_key(day: str) -> Column:
    """Integer ``yyyymmdd`` of a date column; NULL stays NULL."""
    return F.expr(date_key_sql(day))


def fiscal_year(day: Column | str, first_month: int = 10) -> Column:
    """Year in which the fiscal year ends that starts in ``first_month``."""
    starts_new = (F.month(day) >= first_month) & F.lit(first_month > 1)
    return (F.year(day) + starts_new.cast("int")).cast("smallint")


def fiscal_quarter(day: Column | str, first_month: int = 10) -> Column:
    months_in = F.pmod(F.month(day) - F.lit(first_month), F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("smallint")


def padded_name(day: Column | str, pattern: str) -> Column:
    """English month (``MMMM``) or day (``EEEE``) name, blank-padded to 9."""
    return F.rpad(F.date_format(day, pattern), 9, " ")
