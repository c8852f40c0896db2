"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.dates import date_key, fiscal_quarter, fiscal_year, padded_name
from claimweave.functions.labels import RACE, SEX, decode
from claimweave.operators.keys import first_per_key
from claimweave.operators.lineage import cut_lineage
from claimweave.sources.local_rows import literal_table

# Claim types with their part A / part B flags and type code.
CLAIM_TYPES = [
    ("inpatient", "Inpatient Hospital", True, False, "60"),
    ("outpatient", "Outpatient Hospital", False, True, "40"),
    ("carrier", "Carrier (Physician/Supplier)", False, True, "71"),
    ("dme", "Durable Medical Equipment", False, True, "82"),
    ("snf", "Skilled Nursing Facility", True, False, "20"),
    ("hospice", "Hospice", True, False, "50"),
    ("hha", "Home Health Agency", True, False, "10"),
]


def calendar_days(bounds: DataFrame, first: str, last: str, fiscal_start: int = 10) -> DataFrame:
    """Calendar rows for every day between the two dates of a one-row frame."""
    day = F.col("full_date")
    return bounds.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date")
    ).select(
        date_key("full_date").alias("date_key"),
        day,
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        padded_name(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        (F.dayofweek(day) - 1).cast("smallint").alias("day_of_week"),
        padded_name(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        fiscal_year(day, fiscal_start).alias("cms_fiscal_year"),
        fiscal_quarter(day, fiscal_start).alias("cms_fiscal_quarter"),
    )


def build_calendar(spark: SparkSession, first: str, last: str, fiscal_start: int = 10) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return calendar_days(bounds, "first", "last", fiscal_start)


def claim_type_dim(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        "claim_type_key string, claim_type_desc string, is_part_a boolean, "
        "is_part_b boolean, nch_clm_type_cd string",
        CLAIM_TYPES,
    )


def snapshot_span(snapshots: DataFrame, key: str = "bene_id", year: str = "enrollmt_ref_yr"):
    """First and last year of each person, and the number of snapshots."""
    return snapshots.groupBy(key).agg(
        F.min(year).alias("first_year_in_data"),
        F.max(year).alias("last_year_in_data"),
        F.count(F.lit(1)).cast("smallint").alias("years_in_data"),
    )


PERSON_ATTRIBUTES = [
    "bene_birth_dt",
    "bene_death_dt",
    "sex_ident_cd",
    "rti_race_cd",
    "state_code",
    "county_cd",
    "zip_cd",
    "esrd_ind",
    "entlmt_rsn_orig",
    "entlmt_rsn_curr",
]


def build_beneficiary_dim(snapshots: DataFrame) -> DataFrame:
    """One row per person: decoded attributes of the latest snapshot, plus span.

    Latest row and span come out of one aggregation, so the snapshots are read
    and shuffled once.  A snapshot without a year counts as the latest, and a
    hash of the attributes settles two snapshots of one year.
    """
    attributes = ", ".join(PERSON_ATTRIBUTES)
    # a missing year first, then the year, then the tie-break
    recency = f"struct(enrollmt_ref_yr IS NULL, enrollmt_ref_yr, xxhash64({attributes}))"
    persons = (
        snapshots.where("bene_id IS NOT NULL")
        .groupBy("bene_id")
        .agg(
            F.expr(f"max_by(struct({attributes}), {recency})").alias("latest"),
            F.min("enrollmt_ref_yr").alias("first_year_in_data"),
            F.max("enrollmt_ref_yr").alias("last_year_in_data"),
            F.count(F.lit(1)).cast("smallint").alias("years_in_data"),
        )
    )
    return persons.select(
        "bene_id",
        "latest.bene_birth_dt",
        "latest.bene_death_dt",
        decode("latest.sex_ident_cd", SEX).alias("sex_desc"),
        decode("latest.rti_race_cd", RACE).alias("race_desc"),
        F.expr("latest.bene_death_dt IS NULL").alias("is_alive"),
        *[f"latest.{name}" for name in PERSON_ATTRIBUTES[4:]],
        "first_year_in_data",
        "last_year_in_data",
        "years_in_data",
    )


#: From the roots down, so each node is met once.  A cycle hangs on no root, and a node
#: that its own path holds isn't met again.
DESCEND = """
WITH RECURSIVE chain(node, top, path) MAX RECURSION LEVEL 1000 AS (
  SELECT code, code, array(code) FROM {inner} WHERE parent IS NULL
  UNION ALL
  SELECT i.code, c.top, array_append(c.path, i.code)
  FROM chain c JOIN {inner} i ON i.parent = c.node AND NOT array_contains(c.path, i.code)
)
SELECT i.code AS node, c.top, i.parent AS second, i.description AS node_desc
FROM {inner} i LEFT JOIN chain c ON c.node = i.code
"""


def flatten_hierarchy(codes: DataFrame) -> DataFrame:
    """Ancestors of every code of a ``(code, parent, description)`` tree.

    Gives the nearest, second-nearest and farthest ancestor with descriptions,
    and whether the code is a leaf.  A code that is listed twice (see ``dedupe_first``)
    and a cycle raise ``ValueError``; a parent that isn't listed is an ancestor
    without a description.

    Only inner nodes are descended to, by one recursive query; leaves, which are most of
    a tree, look up their parent's finished chain once.  Inner nodes and their chains are
    written once each.  More than a million inner nodes need
    ``spark.sql.cteRecursionRowLimit`` raised, as ``build_session`` does.  Every join has a
    side that is unique on the join key and freshly shuffled, which lets Spark split a hot
    parent.
    """
    repeated = codes.groupBy("code").count().where("count > 1").select("code").first()
    if repeated:
        raise ValueError(f"code {repeated['code']} is listed more than once")
    parents = codes.where("parent IS NOT NULL").selectExpr("parent AS code").distinct()
    inner = cut_lineage(parents.join(codes, "code", "left").select("code", "parent", "description"), "inner-codes")
    chain = cut_lineage(codes.sparkSession.sql(DESCEND, inner=inner), "code-chains")
    endless = chain.where("top IS NULL").first()
    if endless:
        raise ValueError(f"the hierarchy above {endless['node']} never ends")

    text = chain.select("node", "node_desc")
    chains = (
        chain.join(text.toDF("top", "top_desc"), "top")
        .join(text.toDF("second", "second_desc"), "second", "left")
    )
    return (
        codes.join(chains, F.expr("parent = node"), "left")
        .join(chain.selectExpr("node AS code", "true AS is_inner"), "code", "left")
        .selectExpr(
            "code AS icd_dgns_cd",
            "description",
            "is_inner IS NULL AS is_billable",
            "top AS chapter_num",
            "top_desc AS chapter_desc",
            "second AS block_code",
            "second_desc AS block_desc",
            "parent AS parent_code",
            "node_desc AS parent_desc",
        )
    )


def build_diagnosis_dim(codes: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Code dimension: the code list, then ``extra`` codes it does not have."""
    both = codes.withColumn("_source", F.lit(0))
    if extra is not None:
        both = both.unionByName(extra.withColumn("_source", F.lit(1)), allowMissingColumns=True)
    return first_per_key(both, ["icd_dgns_cd"], [F.col("_source")]).drop("_source")
