"""Figures that rounding twice, or dropping rows, would get wrong."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimweave.functions.exact import rounded_ratio
from claimweave.operators import reports
from claimweave.operators.cohorts import payments_per_person
from claimweave.plans import bindings, oracle


def ratio(spark, part, whole, digits, scale=0):
    row = spark.sql(f"SELECT {part} AS part, {whole} AS whole")
    return row.select(rounded_ratio(F.col("part"), F.col("whole"), digits, scale)).first()[0]


@pytest.mark.parametrize("part, whole, digits, scale, expected", [
    ("56249L", "25000L", 1, 0, "2.2"), ("-56250L", "25000L", 1, 0, "-2.3"), ("5L", "2L", 0, 0, "3"),
    ("CAST('2501249.999' AS decimal(25,3))", "250000L", 2, 3, "10.00"), ("0L", "7L", 2, 0, "0.00"),
    ("CAST('-0.15' AS decimal(25,2))", "10L", 2, 2, "-0.02"), ("CAST('0.15' AS decimal(25,2))", "10L", 2, 2, "0.02"),
    ("1L", "0L", 2, 0, None), ("CAST(NULL AS bigint)", "1L", 2, 0, None),
    ("CAST('9999999999999999999999.99' AS decimal(25,2))", "1000000000000L", 2, 2, "10000000000.00"),
])
def test_rounded_once(spark, part, whole, digits, scale, expected):
    found = ratio(spark, part, whole, digits, scale)
    assert found == (None if expected is None else Decimal(expected))


def skewed_payments(spark, sign=1):
    """A mean of 10.004999996 a claim."""
    cents = "CASE WHEN id = 0 THEN 1000 WHEN id % 2 = 0 THEN 1001 ELSE 1000 END"
    return spark.range(250_000).selectExpr(
        "CAST(id AS string) AS clm_id", "CAST(id % 100 AS string) AS bene_id", "'snf' AS claim_type_key",
        f"CAST({sign} * {cents} / 100 AS decimal(15,2)) AS clm_pmt_amt",
    ).withColumn("tot_rx_cst_amt", F.col("clm_pmt_amt")).withColumn("brnd_gnrc_cd", F.lit("B")).withColumn(
        "prod_srvc_id", F.lit("1")
    )


@pytest.mark.parametrize("sign", [1, -1])
def test_reports_round_means_once(spark, sign):
    claims = skewed_payments(spark, sign)
    mean = Decimal(sign * 10).quantize(Decimal("0.01"))
    assert reports.claims_by_type(claims).first()["avg_pmt"] == mean
    assert reports.pde_totals(claims).first()["avg_cost_per_event"] == mean
    assert reports.pde_by_kind(claims).first()["avg_cost"] == mean
    payments = payments_per_person(claims, "claim_type_key")
    members = claims.select("bene_id").distinct().selectExpr("bene_id", "'A' AS patient_group")
    assert reports.person_cohort_costs(payments, members).first()["avg_payment"] == mean
    counts = members.selectExpr("bene_id", "'1' AS condition_group", "CAST(1 AS smallint) AS sort_order")
    assert reports.person_avg_payment_by_bucket(payments, counts).first()["avg_payment"] == mean


def test_sql_twin_rounds_negative_means_away_from_zero():
    import duckdb

    sql = f"SELECT {oracle.avg_cents('a')} FROM (VALUES (-0.01::DECIMAL(15,2)), (0.00), (0.00), (-0.01)) t(a)"
    assert duckdb.sql(sql).fetchall() == [(-0.01,)]


def test_prevalence_rounds_once(spark):
    conditions = spark.range(25_000).selectExpr(
        "'x' AS condition_desc", "true AS meets_ccw_criteria", "IF(id < 6249, 3L, 2L) AS claim_count"
    )
    # the mean is 2.24996
    assert reports.condition_prevalence(conditions).first()["avg_claims"] == Decimal("2.2")


def test_slices_keep_everyone(spark):
    counts = spark.createDataFrame(
        [("a", 2, 20200101, "Male"), ("b", 0, 20150101, "Male"), ("c", 0, 19000101, "Female")],
        "bene_id string, condition_count long, first_claim_date_key int, sex_desc string",
    )
    calendar = spark.createDataFrame([(20200101, 2020), (20150101, 2015)], "date_key int, year int")
    by_year = reports.kpi_cards(reports.slice_counts(counts, calendar), "year").collect()
    assert {r.year: (r.total_bene, r.pct_of_population) for r in by_year} == {2020: (1, 100), 2015: (1, 0), None: (1, 0)}
    assert reports.slice_counts(counts, calendar, year=2020).count() == 1
    assert reports.slice_counts(counts, calendar, sex="Male").count() == 2


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_every_line_is_a_diagnosis(spark, sf):
    folder = f"/root/testdata/{sf}"
    lines = bindings.table(spark, folder, "lineitem").count()
    assert bindings.diagnoses(spark, folder).count() == lines


def test_line_without_a_diagnosis_column_fails(spark, monkeypatch):
    table = bindings.table

    def one_more(spark, sf_dir, name):
        df = table(spark, sf_dir, name)
        return df.withColumn("l_linenumber", F.col("l_linenumber") + 1) if name == "lineitem" else df

    monkeypatch.setattr(bindings, "table", one_more)
    with pytest.raises(Exception, match="no diagnosis column for line 8"):
        bindings.diagnoses(spark, "/root/testdata/sf0.001").count()
