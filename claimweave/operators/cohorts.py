"""Per-person condition counts and cohort comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.labels import bucket, bucket_order
from claimweave.operators.lookup import lookup


def denormalize(df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Copy columns from a dimension; rows it does not know keep NULL."""
    return lookup(df, dim, key, columns)


def _copied(
    df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], how: str, colocated: bool
) -> DataFrame:
    """``lookup``, or a plain join where both tables are in equal buckets by the key: then
    nothing is shuffled, but a bucket with a hot key is one task's work."""
    if not colocated:
        return lookup(df, dim, key, columns, how)
    return df.join(dim.select(key, *columns), key, how)


def confirmed_per_person(conditions: DataFrame) -> DataFrame:
    """Confirmed conditions per person and the key of the earliest one."""
    return (
        conditions.where("meets_ccw_criteria")
        .groupBy("bene_id")
        .agg(
            F.count(F.lit(1)).alias("condition_count"),
            F.min("first_claim_date_key").alias("first_claim_date_key"),
        )
    )


def condition_counts(
    persons: DataFrame, conditions: DataFrame, cap: int = 7, default_key: int = 20150101
) -> DataFrame:
    """Confirmed conditions of every person, zero included, with its bucket.

    Conditions are aggregated before the join, so both sides are unique on the
    person and no row is multiplied.
    """
    count = F.coalesce("condition_count", F.lit(0).cast("bigint"))
    joined = persons.select("bene_id", "sex_desc").join(
        confirmed_per_person(conditions), "bene_id", "left"
    )
    return joined.select(
        "bene_id",
        count.alias("condition_count"),
        bucket(count, cap).alias("condition_group"),
        bucket_order(count, cap).alias("sort_order"),
        F.coalesce("first_claim_date_key", F.lit(default_key)).alias("first_claim_date_key"),
        "sex_desc",
    )


def tag_claims(claims: DataFrame, counts: DataFrame, colocated: bool = False) -> DataFrame:
    """Claims with the condition bucket of their person.  Claims of a person the
    counts do not know keep a NULL bucket but sort as zero.  ``colocated`` says that both are
    tables in equal buckets by person."""
    buckets = counts.withColumnRenamed("sort_order", "condition_sort_order")
    return _copied(
        claims, buckets, "bene_id", ["condition_group", "condition_sort_order"], "left", colocated
    ).withColumn(
        "condition_sort_order",
        F.coalesce("condition_sort_order", F.lit(0).cast("smallint")),
    )


def cohort_members(
    conditions: DataFrame,
    a: str = "ckd",
    b: str = "diabetes",
    label_a: str = "CKD",
    label_b: str = "Diabetes",
) -> DataFrame:
    """Persons with a confirmed condition ``a``, ``b`` or both, and which."""
    return (
        conditions.where(F.col("condition").isin(a, b) & F.col("meets_ccw_criteria"))
        .groupBy("bene_id")
        .agg(
            F.bool_or(F.col("condition") == a).alias("in_a"),
            F.bool_or(F.col("condition") == b).alias("in_b"),
        )
        .select(
            "bene_id",
            F.when(F.col("in_a") & F.col("in_b"), f"{label_a} + {label_b}")
            .when(F.col("in_a"), f"{label_a} only")
            .otherwise(f"{label_b} only")
            .alias("patient_group"),
        )
    )


def cohort_claims(claims: DataFrame, members: DataFrame, colocated: bool = False) -> DataFrame:
    """Claims of cohort members, labelled with their group.  Membership is one
    table, unique per person, so the claims are joined once.  ``colocated`` as in
    :func:`tag_claims`."""
    wanted = claims.select(
        "claim_type_key",
        "clm_pmt_amt",
        "bene_id",
        F.col("from_date_key").alias("first_claim_date_key"),
    )
    return _copied(wanted, members, "bene_id", ["patient_group"], "inner", colocated).select(
        "patient_group", "claim_type_key", "clm_pmt_amt", "bene_id", "first_claim_date_key"
    )


def payments_per_person(claims: DataFrame, *by: str) -> DataFrame:
    """Claims and payments summed up per person (and ``by``), before any join:
    a person with very many claims becomes a few rows inside the map tasks."""
    return claims.groupBy("bene_id", *by).agg(
        F.count(F.lit(1)).alias("claims"),
        F.count("clm_pmt_amt").alias("paid_claims"),
        F.sum("clm_pmt_amt").alias("total_payment"),
    )
