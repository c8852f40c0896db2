"""Fact tables of the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.dates import date_key, date_key_sql

# Claim fact columns, and the types that carry the optional ones.
CLAIM_COLUMNS = {
    "clm_id": "string",
    "bene_id": "string",
    "claim_type_key": "string",
    "clm_from_dt": "date",
    "clm_thru_dt": "date",
    "from_date_key": "int",
    "thru_date_key": "int",
    "clm_pmt_amt": "decimal(15,2)",
    "clm_tot_chrg_amt": "decimal(15,2)",
    "prncpal_dgns_cd": "string",
    "prvdr_state_cd": "string",
    "org_npi_num": "string",
    "clm_admsn_dt": "date",
    "nch_bene_dschrg_dt": "date",
    "clm_drg_cd": "string",
    "clm_utlztn_day_cnt": "int",
    "ptnt_dschrg_stus_cd": "string",
}
FACILITY = ("inpatient", "outpatient", "snf", "hospice", "hha")
CARRIED_BY = {
    "clm_tot_chrg_amt": FACILITY,
    "prvdr_state_cd": FACILITY,
    "org_npi_num": FACILITY,
    "ptnt_dschrg_stus_cd": FACILITY,
    "clm_admsn_dt": ("inpatient", "snf", "hha"),
    "nch_bene_dschrg_dt": ("inpatient", "snf", "hospice"),
    "clm_drg_cd": ("inpatient", "snf"),
    "clm_utlztn_day_cnt": ("inpatient", "snf", "hospice"),
}
DIAGNOSIS_WIDTH = {
    "inpatient": 25,
    "outpatient": 25,
    "carrier": 8,
    "dme": 5,
    "snf": 25,
    "hospice": 6,
    "hha": 25,
}


def build_enrollment(snapshots: DataFrame, partial_years: Sequence[int] = (2025,)) -> DataFrame:
    """Months of coverage per person and year, with flags; an unknown number of
    months gives an unknown flag."""
    part_a = F.col("bene_hi_cvrage_tot_mons")
    part_b = F.col("bene_smi_cvrage_tot_mons")
    hmo = F.col("bene_hmo_cvrage_tot_mons")
    dual = F.col("dual_elgbl_mons")
    part_d = F.col("ptd_plan_cvrg_mons")
    return snapshots.select(
        "bene_id",
        "enrollmt_ref_yr",
        part_a.alias("part_a_months"),
        part_b.alias("part_b_months"),
        hmo.alias("hmo_months"),
        dual.alias("dual_elgbl_months"),
        part_d.alias("part_d_months"),
        (part_a == 12).alias("is_full_year_part_a"),
        (part_b == 12).alias("is_full_year_part_b"),
        (part_d == 12).alias("is_full_year_part_d"),
        (dual > 0).alias("is_any_dual_eligible"),
        (hmo > 0).alias("is_any_hmo"),
        F.coalesce(F.col("enrollmt_ref_yr").isin(*partial_years), F.lit(False)).alias(
            "is_partial_year"
        ),
    )


DATE_KEYS = {
    "from_date_key": date_key_sql("clm_from_dt"),
    "thru_date_key": date_key_sql("clm_thru_dt"),
}


def union_headers(headers: dict[str, DataFrame]) -> DataFrame:
    """Claim fact from one header table per claim type.

    Columns a type does not carry become typed NULLs; they are not read from
    its table even if it has them.
    """

    def source(name: str, claim_type: str) -> str:
        if name == "claim_type_key":
            return f"'{claim_type}'"
        if claim_type not in CARRIED_BY.get(name, (claim_type,)):
            return "NULL"
        return DATE_KEYS.get(name, name)

    parts = [
        header.selectExpr(
            *[f"cast({source(name, kind)} AS {t}) AS {name}" for name, t in CLAIM_COLUMNS.items()]
        )
        for kind, header in headers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def shape_headers(headers: DataFrame) -> DataFrame:
    """The same fact from one header table that holds all types, told apart by
    ``claim_type_key``: one pass instead of one branch per type."""

    def source(name: str) -> str:
        if name not in CARRIED_BY:
            return DATE_KEYS.get(name, name)
        types = ", ".join(f"'{claim_type}'" for claim_type in CARRIED_BY[name])
        return f"CASE WHEN claim_type_key IN ({types}) THEN {name} END"

    return headers.selectExpr(
        *[f"cast({source(name)} AS {t}) AS {name}" for name, t in CLAIM_COLUMNS.items()]
    )


def unpivot_codes(df: DataFrame, prefix: str, width: int, ids: Sequence[str]) -> DataFrame:
    """``<prefix>1`` .. ``<prefix><width>`` as rows (code, position), without NULLs."""
    pairs = ", ".join(f"{prefix}{i}, cast({i} AS smallint)" for i in range(1, width + 1))
    return df.selectExpr(
        *ids, f"stack({width}, {pairs}) AS (icd_dgns_cd, dgns_position)"
    ).where("icd_dgns_cd IS NOT NULL")


def diagnosis_fact(headers: dict[str, DataFrame]) -> DataFrame:
    """Long-format diagnoses of all claim types, each to its own width."""
    ids = ["clm_id", "bene_id", "claim_type_key", "clm_from_dt"]
    return reduce(
        DataFrame.unionByName,
        [
            unpivot_codes(
                header.withColumn("claim_type_key", F.lit(claim_type)),
                "icd_dgns_cd",
                DIAGNOSIS_WIDTH[claim_type],
                ids,
            )
            for claim_type, header in headers.items()
        ],
    )


def build_pde_fact(pde: DataFrame) -> DataFrame:
    return pde.select(
        "pde_id",
        "bene_id",
        "srvc_dt",
        date_key("srvc_dt").alias("srvc_date_key"),
        "prod_srvc_id",
        "prscrbr_id",
        "plan_cntrct_rec_id",
        "days_suply_num",
        "qty_dspnsd_num",
        "fill_num",
        "brnd_gnrc_cd",
        "drug_cvrg_stus_cd",
        "tot_rx_cst_amt",
        "ptnt_pay_amt",
        "cvrd_d_plan_pd_amt",
        "lics_amt",
    )
