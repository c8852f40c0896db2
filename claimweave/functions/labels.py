"""Code decoding and bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code meanings.
SEX = {"1": "Male", "2": "Female"}
RACE = {
    "1": "White",
    "2": "Black",
    "4": "Asian/Pacific Islander",
    "5": "Hispanic",
    "6": "American Indian/Alaska Native",
}
DRUG_COVERAGE = {"C": "Covered by Part D", "E": "Supplemental", "O": "Over-the-counter"}


def decode(code: Column | str, meanings: dict[str, str], default: str = "Unknown") -> Column:
    """Label of a code; codes without one, and NULL, give ``default``."""
    code = F.col(code) if isinstance(code, str) else code
    label = F.lit(default)
    for value, meaning in reversed(meanings.items()):
        label = F.when(code == value, meaning).otherwise(label)
    return label


def bucket(count: Column | str, cap: int = 7) -> Column:
    """``'0'``, ``'1'`` ... with everything from ``cap`` up as ``'<cap>+'``."""
    count = F.col(count) if isinstance(count, str) else count
    return F.when(count >= cap, f"{cap}+").otherwise(count.cast("string"))


def bucket_order(count: Column | str, cap: int = 7) -> Column:
    """Sort position of :func:`bucket`."""
    return F.least(F.col(count) if isinstance(count, str) else count, F.lit(cap)).cast("smallint")
