import pytest
from pyspark.sql import functions as F

from claimweave.operators.cohorts import cohort_claims, payments_per_person, tag_claims
from claimweave.operators.lookup import hot_keys, lookup
from claimweave.operators.reports import (
    avg_payment_by_bucket,
    cohort_costs,
    person_avg_payment_by_bucket,
    person_cohort_costs,
)


def claims(spark, n=6000):
    """A third of the claims belong to one person, a sixth to nobody."""
    person = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 6 != 1, F.concat(F.lit("p"), F.col("id") % 997))
    )
    return spark.range(n).select(
        F.col("id").cast("string").alias("clm_id"),
        person.alias("bene_id"),
        F.when(F.col("id") % 2 == 0, "snf").otherwise("dme").alias("claim_type_key"),
        F.when(F.col("id") % 5 > 0, F.col("id") / 7).cast("decimal(15,2)").alias("clm_pmt_amt"),
        F.lit(20160101).alias("from_date_key"),
    )


def persons(spark):
    known = spark.range(0, 997, 2).select(F.concat(F.lit("p"), "id").alias("bene_id"))
    hot = spark.sql("SELECT 'hot' AS bene_id")
    return known.union(hot).select(
        "bene_id",
        F.when(F.col("bene_id") == "hot", "A").otherwise("B").alias("patient_group"),
        F.when(F.col("bene_id") == "hot", "7+").otherwise("1").alias("condition_group"),
        F.when(F.col("bene_id") == "hot", 7).otherwise(1).cast("smallint").alias("sort_order"),
    )


def test_hot_keys_are_found(spark, rows_of):
    assert rows_of(hot_keys(claims(spark), "bene_id"), "bene_id") == [("hot",)]
    assert hot_keys(claims(spark).where("false"), "bene_id").count() == 0
    assert hot_keys(claims(spark).where("bene_id IS NULL"), "bene_id").count() == 0


def test_sketches_are_merged_in_groups(spark):
    """The one task at the end reads a sketch for each group, not for each map task."""
    hot = hot_keys(claims(spark).repartition(50), "bene_id")
    plan = hot._jdf.queryExecution().sparkPlan().toString()
    assert "approx_top_k_accumulate" in plan and "approx_top_k_combine" in plan
    exchanges = hot._jdf.queryExecution().executedPlan().toString()
    assert exchanges.count("Exchange hashpartitioning") == 2 and "SinglePartition" not in exchanges
    assert [r.bene_id for r in hot.collect()] == ["hot"]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_is_a_join(spark, rows_of, how):
    df, dim = claims(spark), persons(spark)
    plain = df.join(dim.select("bene_id", "patient_group"), "bene_id", how)
    columns = [*df.columns, "patient_group"]
    salted = lookup(df, dim, "bene_id", ["patient_group"], how)
    assert salted.columns == columns
    assert rows_of(salted) == rows_of(plain, *columns)


def test_hot_rows_travel_apart(spark):
    """With broadcasting off, no shuffle partition holds the hot person's rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(claims(spark), persons(spark), "bene_id", ["patient_group"])
        sizes = [
            r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 6000 and len(sizes) == 4 and max(sizes) < 2000


def test_reports_per_person_agree_with_reports_per_claim(spark):
    df, people = claims(spark), persons(spark)
    per_claim = avg_payment_by_bucket(tag_claims(df, people))
    per_person = person_avg_payment_by_bucket(payments_per_person(df), people)
    assert sorted(map(str, per_claim.collect())) == sorted(map(str, per_person.collect()))
    assert per_claim.count() == 3

    per_claim = cohort_costs(cohort_claims(df, people))
    payments = payments_per_person(df, "claim_type_key")
    per_person = person_cohort_costs(payments, people)
    assert per_claim.collect() == per_person.collect() and per_claim.count() == 4
