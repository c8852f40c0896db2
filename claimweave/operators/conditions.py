"""Chronic conditions from diagnosis codes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.dates import date_key
from claimweave.sources.local_rows import literal_table


class Condition(NamedTuple):
    label: str
    prefixes: tuple[str, ...]


Rules = dict[str, Condition]

# Condition, label and the diagnosis code prefixes that define it.
CCW_RULES: Rules = {
    "diabetes": Condition("Diabetes", ("E10", "E11", "E13")),
    "hypertension": Condition("Hypertension", ("I10", "I11", "I12", "I13", "I15")),
    "ckd": Condition("Chronic Kidney Disease", ("N18",)),
    "heart_failure": Condition("Heart Failure", ("I50",)),
    "afib": Condition("Atrial Fibrillation", ("I48",)),
    "copd": Condition("COPD", ("J44", "J43")),
    "depression": Condition("Depression", ("F32", "F33", "F34")),
    "hyperlipidemia": Condition("Hyperlipidemia", ("E78",)),
    "ihd": Condition("Ischemic Heart Disease", ("I20", "I21", "I22", "I25")),
    "stroke": Condition("Stroke / TIA", ("I63", "I64", "G45")),
    "diabetes_comp": Condition("Diabetes with Complications", ("E116", "E117")),
    "osteoporosis": Condition("Osteoporosis", ("M80", "M81")),
    "alzheimers": Condition("Alzheimers / Dementia", ("G30", "F01", "F02", "F03")),
    "cancer_breast": Condition("Breast Cancer", ("C50",)),
    "cancer_colorectal": Condition("Colorectal Cancer", ("C18", "C19", "C20")),
    "cancer_lung": Condition("Lung Cancer", ("C34",)),
    "cancer_prostate": Condition("Prostate Cancer", ("C61",)),
    "asthma": Condition("Asthma", ("J45",)),
    "obesity": Condition("Obesity", ("E66",)),
    "anxiety": Condition("Anxiety Disorders", ("F40", "F41")),
    "schizophrenia": Condition("Schizophrenia / Psychosis", ("F20", "F25")),
}


def rule_table(spark: SparkSession, rules: Rules = CCW_RULES) -> DataFrame:
    """One row per (condition, label, prefix)."""
    return literal_table(
        spark,
        "condition string, condition_desc string, icd_cd_prefix string",
        [
            (name, rule.label, prefix)
            for name, rule in rules.items()
            for prefix in rule.prefixes
        ],
    )


def prefix_join(df: DataFrame, code: str, rules: Rules = CCW_RULES) -> DataFrame:
    """Every rule whose prefix the code starts with; a code may match several.

    A "starts with" condition would be a nested-loop join.  Here each code is
    cut to the few lengths prefixes have, and the cuts are looked up by
    equality, so the rows stay where they are and the rules are hashed.  A code
    shorter than a length gives the same cut twice, hence the distinct.
    """
    lengths = sorted({len(prefix) for rule in rules.values() for prefix in rule.prefixes})
    cuts = F.array_distinct(F.array(*[F.substring(code, 1, length) for length in lengths]))
    return df.withColumn("icd_cd_prefix", F.explode(cuts)).join(
        rule_table(df.sparkSession, rules), "icd_cd_prefix"
    )


def rollup_conditions(matched: DataFrame) -> DataFrame:
    """Matches per person and condition: first and last date, counts.

    Diagnosis rows are counted, so one claim that names a condition in two
    positions counts twice.  Everything but ``inpatient`` is "outpatient".
    """
    inpatient = F.count_if(F.col("claim_type_key") == "inpatient")
    return matched.groupBy("bene_id", "condition", "condition_desc").agg(
        F.min("clm_from_dt").alias("first_claim_dt"),
        F.max("clm_from_dt").alias("last_claim_dt"),
        F.count(F.lit(1)).cast("int").alias("claim_count"),
        inpatient.cast("int").alias("inpatient_count"),
        (F.count(F.lit(1)) - inpatient).cast("int").alias("outpatient_count"),
    )


def confirm(rollup: DataFrame, min_inpatient: int = 1, min_outpatient: int = 2) -> DataFrame:
    """Add the confirmation flag, and year and key of the first claim."""
    return rollup.select(
        "*",
        (
            (F.col("inpatient_count") >= min_inpatient)
            | (F.col("outpatient_count") >= min_outpatient)
        ).alias("meets_ccw_criteria"),
        F.year("first_claim_dt").cast("smallint").alias("first_claim_year"),
        date_key("first_claim_dt").alias("first_claim_date_key"),
    )


def chronic_conditions(diagnoses: DataFrame, rules: Rules = CCW_RULES) -> DataFrame:
    """Condition table of a long-format diagnosis fact."""
    return confirm(rollup_conditions(prefix_join(diagnoses, "icd_dgns_cd", rules)))
