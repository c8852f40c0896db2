import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimweave.operators.keys import dedupe_first, first_per_key, latest_per_key
from claimweave.operators.staging import split_header, split_line
from claimweave.sources.layouts import cols

ROWS = st.lists(
    st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2)),
    min_size=1,
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_latest_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, yr int, v int")
    got = latest_per_key(df, ["k"], "yr").collect()
    assert sorted(r.k for r in got) == sorted({k for k, _, _ in rows})
    for r in got:
        mine = [(yr, v) for k, yr, v in rows if k == r.k]
        best = None if any(yr is None for yr, _ in mine) else max(yr for yr, _ in mine)
        assert r.yr == best and (r.yr, r.v) in mine


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("a", 1, i) for i in range(50)] + [("b", 1, i) for i in range(50)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, o int, v int").repartition(seed + 1)
        picks.add(tuple(sorted(map(tuple, first_per_key(df, ["k"], [F.col("o")]).collect()))))
    assert len(picks) == 1


def test_dedupe_keeps_first_seen(spark, rows_of):
    df = spark.createDataFrame(
        [("A", 3, "late"), ("A", 1, "early"), ("B", 2, "only")], "code string, pos int, d string"
    )
    assert rows_of(dedupe_first(df, "code", "pos"), "code", "d") == [("A", "early"), ("B", "only")]


LAYOUT = cols("clm_id bene_id clm_pmt_amt:N clm_line_num:I hcpcs_cd")


def hot_claims(spark, n=6000):
    """A third of all lines belong to one claim."""
    claim = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") / 4).cast("long")
    return spark.range(n).select(
        claim.cast("string").alias("clm_id"),
        F.concat(F.lit("-"), claim % 7).alias("bene_id"),
        (claim * 10).cast("string").alias("clm_pmt_amt"),
        F.col("id").cast("string").alias("clm_line_num"),
        F.lit(" x ").alias("hcpcs_cd"),
    )


def test_split_with_a_hot_claim(spark):
    raw = hot_claims(spark)
    header, line = split_header(raw, LAYOUT), split_line(raw, LAYOUT)
    assert header.columns == ["clm_id", "bene_id", "clm_pmt_amt"]
    assert line.columns == ["clm_id", "line_num", "hcpcs_cd"]
    assert header.count() == raw.select("clm_id").distinct().count()
    assert line.count() == raw.count()
    once = raw.select("clm_id", F.col("clm_pmt_amt").cast("decimal(15,2)")).distinct()
    assert header.agg(F.sum("clm_pmt_amt")).first() == once.agg(F.sum("clm_pmt_amt")).first()
    assert line.where("hcpcs_cd <> 'x'").count() == 0


def test_header_comes_from_the_lowest_line(spark, rows_of):
    raw = spark.createDataFrame(
        [("1", "-1", "5", "10", "a"), ("1", "-1", "7", "9", "b"), ("1", "-1", "8", None, "c"),
         ("2", "-2", "3", "bad", "d")],
        "clm_id string, bene_id string, clm_pmt_amt string, clm_line_num string, hcpcs_cd string",
    )
    got = rows_of(split_header(raw, LAYOUT), "clm_id", F.col("clm_pmt_amt").cast("int"))
    assert got == [("1", 7), ("2", 3)]


def test_late_columns_give_the_same_headers(spark, rows_of):
    stored = spark.createDataFrame(
        [("1", "5", "10"), ("1", "7", "9"), ("1", "8", None), ("2", "3", "bad"), ("2", "4", None), (None, "6", "2"),
         (None, "9", "1"), ("3", "1", "1"), ("3", "2", " 1"), ("3", "2", " 1"), ("4", "x", None)],
        "clm_id string, clm_pmt_amt string, clm_line_num string",
    )
    def widen(rows):
        return rows.selectExpr("clm_id", "concat('-', clm_id) AS bene_id", "clm_pmt_amt", "clm_line_num", "clm_pmt_amt AS hcpcs_cd")
    raw, late = widen(stored), split_header(stored, LAYOUT, widen=widen)
    assert late.dtypes == split_header(raw, LAYOUT).dtypes
    assert rows_of(late) == rows_of(split_header(raw, LAYOUT)) and late.count() == 5


def test_wide_headers_are_made_late(spark, tmp_path):
    table = spark.createDataFrame([("1", "5", "2"), ("1", "6", "1")], "clm_id string, clm_pmt_amt string, clm_line_num string")
    table.write.parquet(f"{tmp_path}/raw")
    def widen(rows):
        return rows.selectExpr("*", "concat('made', clm_id) AS bene_id", "'' AS hcpcs_cd")
    plan = split_header(spark.read.parquet(f"{tmp_path}/raw"), LAYOUT, widen=widen)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("concat(made") < plan.index("LeftSemi")  # nearer to the result


def test_rows_are_cut_before_the_shuffle(spark):
    plan = split_header(hot_claims(spark), LAYOUT)._jdf.queryExecution().executedPlan().toString()
    limit = plan.index("Exchange hashpartitioning(clm_id")
    assert "Partial" in plan[limit:] and "WindowGroupLimit" in plan[limit:]
