"""Summary reports over the mart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from claimweave.functions.exact import rounded_ratio
from claimweave.functions.labels import DRUG_COVERAGE, decode


#: Registers of a sketch, as a power of two.
SKETCH_BITS = 14


def rows() -> Column:
    return F.count(F.lit(1))


def _whole_sum(amount: str) -> Column:
    return F.round(F.sum(amount))


def _cents_avg(amount: str) -> Column:
    return rounded_ratio(F.sum(amount), F.count(amount), 2, scale=2)


def claims_by_type(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy("claim_type_key")
        .agg(
            rows().alias("claims"),
            _whole_sum("clm_pmt_amt").alias("total_pmt"),
            _cents_avg("clm_pmt_amt").alias("avg_pmt"),
        )
        .orderBy(F.col("claims").desc())
    )


def diagnosis_by_type(diagnoses: DataFrame) -> DataFrame:
    """Rows, claims and codes of each type.

    Claims and codes are counted apart and the two small results joined: together they
    would multiply the rows, and every map task would send each pair on."""
    claims = (
        diagnoses.groupBy("claim_type_key", "clm_id")
        .agg(rows().alias("n"))
        .groupBy("claim_type_key")
        .agg(F.sum("n").alias("diagnosis_rows"), F.count("clm_id").alias("unique_claims"))
    )
    codes = (
        diagnoses.select("claim_type_key", "icd_dgns_cd")
        .distinct()
        .groupBy(F.col("claim_type_key").alias("of_type"))
        .agg(F.count("icd_dgns_cd").alias("unique_codes"))
    )
    return (
        claims.join(codes, F.col("claim_type_key").eqNullSafe(F.col("of_type")))
        .select("claim_type_key", "diagnosis_rows", "unique_claims", "unique_codes")
        .orderBy(F.col("diagnosis_rows").desc())
    )


def distinct_sketches(df: DataFrame, by: Sequence[str], *columns: str) -> DataFrame:
    """Rows and, for each of the columns, a HyperLogLog sketch of its distinct values, per
    group.  A sketch has 4 KB whatever it counts, so a table of these answers later how many
    values any union of groups has, where exact distinct counts can't be added up."""
    sketches = [F.hll_sketch_agg(name, F.lit(SKETCH_BITS)).alias(name) for name in columns]
    return df.groupBy(*by).agg(rows().alias("rows"), *sketches)


def distinct_estimates(sketches: DataFrame, by: Sequence[str], *columns: str) -> DataFrame:
    """Rows and distinct values per coarser group of ``distinct_sketches``, whose sketches
    are merged; the standard error is about 0.8 %."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in columns]
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), *merged)


def _as_one_row(*parts: DataFrame) -> DataFrame:
    """One-row frames of different columns as one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def _distinct(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(column).distinct().agg(F.count(column).alias(name))


def pde_totals(pde: DataFrame) -> DataFrame:
    """Events, cost, persons and products.  Each distinct count reads its own column;
    together they would send every row once for each of them."""
    return _as_one_row(
        pde.agg(
            rows().alias("total_pde"),
            _whole_sum("tot_rx_cst_amt").alias("total_drug_cost"),
            _cents_avg("tot_rx_cst_amt").alias("avg_cost_per_event"),
        ),
        _distinct(pde, "bene_id", "unique_bene"),
        _distinct(pde, "prod_srvc_id", "unique_ndcs"),
    )


def pde_load_totals(pde: DataFrame) -> DataFrame:
    """Staged drug events: uniqueness, missing values, date range, cost."""
    return pde.agg(
        rows().alias("total_rows"),
        F.count_distinct("pde_id").alias("unique_pde_ids"),
        F.count_if(F.col("pde_id").isNull()).alias("null_pde_id"),
        F.count_if(F.col("bene_id").isNull()).alias("null_bene_id"),
        F.count_if(F.col("srvc_dt").isNull()).alias("null_srvc_dt"),
        F.count_if(F.col("prod_srvc_id").isNull()).alias("null_ndc"),
        F.count_if(F.col("tot_rx_cst_amt").isNull()).alias("null_cost"),
        F.min("srvc_dt").alias("min_date"),
        F.max("srvc_dt").alias("max_date"),
        _whole_sum("tot_rx_cst_amt").alias("total_drug_cost"),
        _cents_avg("tot_rx_cst_amt").alias("avg_cost_per_event"),
    )


def pde_by_kind(pde: DataFrame) -> DataFrame:
    return (
        pde.groupBy("brnd_gnrc_cd")
        .agg(
            rows().alias("events"),
            _whole_sum("tot_rx_cst_amt").alias("total_cost"),
            _cents_avg("tot_rx_cst_amt").alias("avg_cost"),
        )
        .orderBy(F.col("events").desc())
    )


def pde_by_status(pde: DataFrame) -> DataFrame:
    return (
        pde.groupBy("drug_cvrg_stus_cd")
        .agg(rows().alias("events"), _whole_sum("tot_rx_cst_amt").alias("total_cost"))
        .select(
            "drug_cvrg_stus_cd",
            decode("drug_cvrg_stus_cd", DRUG_COVERAGE).alias("description"),
            "events",
            "total_cost",
        )
        .orderBy(F.col("events").desc())
    )


def condition_prevalence(conditions: DataFrame) -> DataFrame:
    return (
        conditions.groupBy("condition_desc")
        .agg(
            rows().alias("total_bene"),
            F.count_if("meets_ccw_criteria").alias("confirmed_bene"),
            rounded_ratio(F.sum("claim_count"), F.count("claim_count"), 1).alias("avg_claims"),
        )
        .orderBy(F.col("confirmed_bene").desc())
    )


def bucket_distribution(counts: DataFrame) -> DataFrame:
    return (
        counts.groupBy("condition_group", "sort_order")
        .agg(rows().alias("bene_count"))
        .orderBy("sort_order")
    )


def cohort_costs(cohort: DataFrame) -> DataFrame:
    return (
        cohort.groupBy("patient_group", "claim_type_key")
        .agg(rows().alias("claims"), _cents_avg("clm_pmt_amt").alias("avg_payment"))
        .orderBy("patient_group", "claim_type_key")
    )


def calendar_totals(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        rows().alias("total_days"),
        F.min("full_date").alias("min_date"),
        F.max("full_date").alias("max_date"),
    )


def person_totals(persons: DataFrame) -> DataFrame:
    return persons.agg(
        rows().alias("total_bene"),
        F.count_if("is_alive").alias("alive"),
        F.count_if(~F.col("is_alive")).alias("deceased"),
        F.count_if(F.col("sex_desc") == "Male").alias("male"),
        F.count_if(F.col("sex_desc") == "Female").alias("female"),
    )


def enrollment_totals(enrollment: DataFrame) -> DataFrame:
    return enrollment.agg(
        rows().alias("total_rows"),
        F.count_distinct("bene_id").alias("unique_bene"),
        F.min("enrollmt_ref_yr").alias("min_year"),
        F.max("enrollmt_ref_yr").alias("max_year"),
        F.count_if("is_partial_year").alias("partial_year_rows"),
    )


def code_dim_totals(codes: DataFrame) -> DataFrame:
    return codes.agg(
        rows().alias("total_codes"),
        F.count_if("is_billable").alias("billable_codes"),
        F.count_if(~F.col("is_billable")).alias("header_codes"),
        F.count_distinct("chapter_num").alias("chapters"),
    )


def list_claim_types(dim: DataFrame) -> DataFrame:
    return dim.orderBy("claim_type_key")


def _cards(groups: GroupedData, *more: Column) -> DataFrame:
    n = F.col("condition_count")
    confirmed = F.count_if(n > 0)
    return groups.agg(
        *more,
        rows().alias("total_bene"),
        confirmed.alias("confirmed_bene"),
        rounded_ratio(confirmed * 100, rows(), 1).alias("pct_of_population"),
        rounded_ratio(F.sum(n), confirmed, 2).alias("avg_conditions"),
        F.count_if(n >= 5).alias("high_risk_bene"),
    )


def kpi_cards(counts: DataFrame, *by: str) -> DataFrame:
    """Confirmed persons, their share, mean conditions of the confirmed, and
    persons with five or more; per group when ``by`` names columns."""
    return _cards(counts.groupBy(*by))


def kpi_cube(counts: DataFrame, *by: str) -> DataFrame:
    """:func:`kpi_cards` for every combination of the slicers ``by``, one aggregate for all.

    ``level`` says which of them a row is over all of: bit by bit, the last slicer in the
    lowest; so 0 is the finest slice, and a NULL slicer with its bit unset is a value."""
    return _cards(counts.cube(*by), F.grouping_id().cast("int").alias("level"))


def top_conditions(conditions: DataFrame, k: int = 6) -> DataFrame:
    """The ``k`` conditions with most confirmed persons; ties by name."""
    return (
        conditions.where("meets_ccw_criteria")
        .groupBy("condition_desc")
        .agg(rows().alias("confirmed_bene"))
        .orderBy(F.col("confirmed_bene").desc(), "condition_desc")
        .limit(k)
    )


def avg_payment_by_bucket(tagged_claims: DataFrame) -> DataFrame:
    return (
        tagged_claims.groupBy("condition_group", "condition_sort_order")
        .agg(rows().alias("claims"), _cents_avg("clm_pmt_amt").alias("avg_payment"))
        .orderBy("condition_sort_order")
    )


def _pooled_avg() -> Column:
    return rounded_ratio(F.sum("total_payment"), F.sum("paid_claims"), 2, scale=2)


def person_avg_payment_by_bucket(payments: DataFrame, counts: DataFrame) -> DataFrame:
    """:func:`avg_payment_by_bucket` of payments per person: the same figures
    without joining single claims.  Persons the counts do not know have no
    bucket and sort as zero."""
    buckets = counts.select("bene_id", "condition_group", "sort_order")
    return (
        payments.join(buckets, "bene_id", "left")
        .groupBy(
            "condition_group",
            F.coalesce("sort_order", F.lit(0).cast("smallint")).alias("condition_sort_order"),
        )
        .agg(F.sum("claims").alias("claims"), _pooled_avg().alias("avg_payment"))
        .orderBy("condition_sort_order")
    )


def person_cohort_costs(payments: DataFrame, members: DataFrame) -> DataFrame:
    """:func:`cohort_costs` of payments per person and claim type."""
    return (
        payments.join(members, "bene_id")
        .groupBy("patient_group", "claim_type_key")
        .agg(F.sum("claims").alias("claims"), _pooled_avg().alias("avg_payment"))
        .orderBy("patient_group", "claim_type_key")
    )


def slice_counts(
    counts: DataFrame,
    calendar: DataFrame,
    year: int | None = None,
    sex: str | None = None,
) -> DataFrame:
    """Per-person counts with the year of the first condition, cut to one year
    and/or sex; feed the result to any report over counts.

    Persons without a confirmed condition are in the year of the default key, and
    persons whose key the calendar lacks are in the year NULL, so the years together
    hold everyone."""
    days = calendar.select(F.col("date_key").alias("first_claim_date_key"), "year")
    if sex is not None:
        counts = counts.where(F.col("sex_desc") == sex)
    if year is not None:
        return counts.join(days.where(F.col("year") == year), "first_claim_date_key")
    return counts.join(days, "first_claim_date_key", "left")
