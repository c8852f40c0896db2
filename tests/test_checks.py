from decimal import Decimal

from pyspark.sql import functions as F

from claimweave.operators import checks
from claimweave.operators.checks import Split, Total


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_row_counts(spark, rows_of):
    got = checks.check_row_counts(
        {"a": spark.range(3), "b": spark.range(2), "c": spark.range(1)}, {"a": 3, "b": 3}
    )
    assert rows_of(got) == [
        ("a", 3, 3, "OK"), ("b", 2, 3, "MISMATCH"), ("c", 1, None, "MISMATCH"),
    ]


def test_nulls_fanout_unique(spark, rows_of):
    df = frame(spark, [("x",), ("x",), ("y",), (None,)], "k string")
    none = frame(spark, [], "k string")
    assert rows_of(checks.check_nulls({"t": df, "n": none}, "k")) == [
        ("n", 0, "OK"), ("t", 1, "HAS NULLS"),
    ]
    assert rows_of(checks.check_key_fanout({"t": df, "n": none}, "k")) == [
        ("n", 0, 0, 0, None, "OK"), ("t", 4, 2, 1, Decimal("2.0"), "HAS NULLS"),
    ]
    assert rows_of(checks.check_unique(df, "t", "k")) == [("t", 4, 2, 2, "DUPLICATES FOUND")]
    pairs = frame(spark, [("x", 1), ("x", 2)], "k string, y int")
    assert rows_of(checks.check_unique(pairs, "t", ["k", "y"])) == [("t", 2, 2, 0, "OK")]


def test_id_sign_ignores_text(spark, rows_of):
    df = frame(spark, [("-1",), ("-1",), ("5",), ("abc",), (None,)], "k string")
    assert rows_of(checks.check_id_sign(df, "t", "k")) == [("t", 3, 1, 1, "HAS POSITIVE IDs")]


def test_formats_amounts_lengths(spark, rows_of):
    dates = frame(spark, [("16-Aug-1999",), ("1999-08-16",), ("5-Aug-1999",), (None,)], "d string")
    assert rows_of(checks.classify_date_format(dates, "d")) == [
        ("DD-Mon-YYYY", 1), ("ISO format", 1), ("Unknown format", 2),
    ]
    amounts = frame(spark, [("0",), ("0.00",), (None,), ("5",)], "a string")
    assert rows_of(checks.check_amounts({"t": amounts}, "a")) == [("t", 4, 1, 1, "HAS NULLS")]
    codes = frame(spark, [("01", "00501"), ("1", "123")], "s string, z string")
    assert rows_of(checks.check_lengths(codes, ["s", "z"], "s", 2)) == [
        (1, 2, 3, 5, 1, "LEADING ZEROS LOST"),
    ]


def test_references_orphans_coverage(spark, rows_of):
    fact = frame(spark, [("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    dim = frame(spark, [("a",), ("a",), ("b",)], "k string")
    assert rows_of(checks.check_ref({"f": fact, "d": dim}, "k", dim)) == [
        ("d", 2, 2, 0, "OK"), ("f", 3, 2, 1, "UNMATCHED"),
    ]
    assert rows_of(checks.check_orphans({"f": (fact, dim), "d": (dim, dim)}, "k")) == [
        ("d", 0, "OK"), ("f", 2, "ORPHANS FOUND"),
    ]
    assert rows_of(checks.check_coverage(fact, dim, "k")) == [(3, 2, Decimal("66.7"))]
    assert rows_of(checks.check_coverage(fact.where("false"), dim, "k")) == [(0, 0, None)]


def test_split_and_totals(spark, rows_of):
    split = Split(spark.range(5), spark.range(2), spark.range(5))
    got = checks.check_split({"a": split, "b": split}, {"a": 2, "b": 3}, {"a": 5, "b": 5})
    assert rows_of(got) == [("a", 2, 5, 5, 2, 5, "OK"), ("b", 2, 5, 5, 3, 5, "MISMATCH")]

    money = frame(spark, [(Decimal("2.30"),), (Decimal("1.20"),)], "m decimal(15,2)")
    same, more = Total(money, F.col("m")), Total(money, (F.col("m") * 2).cast("decimal(15,2)"))
    assert rows_of(checks.check_fan_trap(same, same, "t")) == [
        ("t", Decimal("3.50"), Decimal("3.50"), "OK"),
    ]
    assert rows_of(checks.check_fan_trap(same, more, "t"))[0][3] == "MISMATCH"
    got = checks.check_totals({"same": (same, same), "more": (same, more)})
    assert rows_of(got) == [("more", 4, 7, 3, "MISMATCH"), ("same", 4, 4, 0, "OK")]


def test_duplicates_skipped(spark, rows_of):
    df = frame(spark, [("a",), ("a",), ("b",)], "k string")
    assert rows_of(checks.duplicates_skipped(df, "k")) == [(3, 2, 1)]
