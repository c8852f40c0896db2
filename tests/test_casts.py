from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimweave.functions.casts import (
    apply_layout,
    clean_text,
    safe_to_date,
    safe_to_int,
    safe_to_numeric,
)
from claimweave.functions.dates import date_key, fiscal_quarter, fiscal_year, padded_name
from claimweave.functions.labels import RACE, SEX, bucket, bucket_order, decode
from claimweave.sources.layouts import cols

VECTORS = {
    clean_text: [
        ("  hello  ", "hello"), ("   ", None), ("", None), (None, None), ("a b", "a b"),
        (" 007 ", "007"),
    ],
    safe_to_date: [
        ("16-Aug-1999", date(1999, 8, 16)), ("", None), ("garbage", None), (None, None),
        ("5-Aug-1999", date(1999, 8, 5)), ("16-AUG-1999", date(1999, 8, 16)),
        (" 16-aug-1999 ", date(1999, 8, 16)), ("31-Feb-2020", None), ("1999-08-16", None),
        ("29-Feb-2020", date(2020, 2, 29)), ("29-Feb-2019", None),
    ],
    safe_to_numeric: [
        ("11179.88", Decimal("11179.88")), ("0", Decimal("0.00")), ("", None), ("N/A", None),
        ("1e3", Decimal("1000.00")), ("5.005", Decimal("5.01")), ("-5.005", Decimal("-5.01")),
        ("99999999999999", None), ("NaN", None), (" 12.5 ", Decimal("12.50")), (None, None),
    ],
    safe_to_int: [
        ("42", 42), ("", None), ("3.14", None), ("1.5", None), (" 12 ", 12), ("-7", -7),
        ("99999999999", None), ("abc", None), (None, None),
    ],
}


@pytest.mark.parametrize("cast", VECTORS, ids=lambda f: f.__name__)
def test_safe_casts(spark, cast):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(VECTORS[cast])], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(cast("x")).collect()]
    assert got == [expected for _, expected in VECTORS[cast]]


def test_small_and_precise_kinds(spark):
    df = spark.createDataFrame([("70000", "1.0005"), ("12", "999999999.9995")], "s string, q string")
    rows = apply_layout(df, cols("s:S q:Q"), {"s": "short"}).collect()
    assert [tuple(r) for r in rows] == [(None, Decimal("1.001")), (12, None)]


def test_calendar_expressions(spark):
    days = ["2014-09-30", "2014-10-01", "2014-12-29", "2015-01-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date"))
    rows = df.select(
        date_key("d"), fiscal_year("d"), fiscal_quarter("d"), padded_name("d", "MMMM"),
        fiscal_year("d", 1), fiscal_quarter("d", 7),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (20140930, 2014, 4, "September", 2014, 1),
        (20141001, 2015, 1, "October  ", 2014, 2),
        (20141229, 2015, 1, "December ", 2014, 2),
        (20150101, 2015, 2, "January  ", 2015, 3),
        (None, None, None, None, None, None),
    ]


def test_labels_and_buckets(spark):
    df = spark.createDataFrame([("1", 0), ("2", 6), ("3", 7), (None, 70)], "c string, n long")
    rows = df.select(
        decode("c", SEX), decode("c", RACE), bucket("n"), bucket_order("n"), bucket("n", 5)
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("Male", "White", "0", 0, "0"),
        ("Female", "Black", "6", 6, "5+"),
        ("Unknown", "Unknown", "7+", 7, "5+"),
        ("Unknown", "Unknown", "7+", 7, "5+"),
    ]
