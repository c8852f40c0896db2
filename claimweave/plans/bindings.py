"""Claim-shaped frames over the order tables the tests and benchmarks use.

The claim extracts are not at hand, so orders stand in for claims, order lines
for claim lines, customers for persons, parts for diagnoses and events for drug
events.  Every frame covers its whole source tables.  The text frames are
written as an extract would be: dates like ``16-Aug-1999``, numbers as text,
some fields blank or padded.  Projections are SQL text, which builds faster than
column objects and reads shorter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimweave.functions.casts import apply_layout
from claimweave.operators.conditions import chronic_conditions
from claimweave.operators.cohorts import condition_counts
from claimweave.operators.dimensions import build_beneficiary_dim
from claimweave.operators.facts import shape_headers, unpivot_codes
from claimweave.operators.staging import split_header
from claimweave.sources.layouts import INPATIENT, Layout, cols

CLAIM_LAYOUT: Layout = cols("""
    bene_id clm_id nch_clm_type_cd claim_type_key clm_from_dt:D clm_thru_dt:D clm_pmt_amt:N
    clm_tot_chrg_amt:N prncpal_dgns_cd prvdr_state_cd org_npi_num clm_admsn_dt:D
    nch_bene_dschrg_dt:D clm_drg_cd clm_utlztn_day_cnt:I ptnt_dschrg_stus_cd
    clm_line_num:I rev_cntr_dt:D hcpcs_cd rev_cntr_unit_cnt:I rev_cntr_tot_chrg_amt:N
""")

SNAPSHOT_LAYOUT: Layout = cols("""
    bene_id bene_enrollmt_ref_yr:S state_code county_cd zip_cd bene_birth_dt:D bene_death_dt:D
    sex_ident_cd rti_race_cd age_at_end_ref_yr:S esrd_ind entlmt_rsn_orig entlmt_rsn_curr
    bene_hi_cvrage_tot_mons:S bene_smi_cvrage_tot_mons:S bene_hmo_cvrage_tot_mons:S
    dual_elgbl_mons:S ptd_plan_cvrg_mons:S
""")

PDE_LAYOUT: Layout = cols("""
    pde_id bene_id srvc_dt:D prod_srvc_id prscrbr_id plan_cntrct_rec_id days_suply_num:I
    qty_dspnsd_num:Q fill_num:I brnd_gnrc_cd drug_cvrg_stus_cd tot_rx_cst_amt:N ptnt_pay_amt:N
    cvrd_d_plan_pd_amt:N lics_amt:N
""")

# Diagnosis code stem of each of the 25 part brands.
STEMS = """
    E11 I10 N18 I50 I48 J44 F32 E78 I25 I63 M81 G30 C50
    C18 C34 C61 J45 E66 F41 F20 Z79 K21 M54 E10 R05
""".split()
DX_WIDTH = 7
# Date key of persons without a confirmed condition: a day that orders have.
DEFAULT_KEY = 19950101


# Schemas of the source tables; stating them saves a job per table that would
# open a file to find out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str) -> str:
    return f"cast({column} AS decimal(15,2))"


def _text_date(day: str) -> str:
    return f"date_format({day}, 'dd-MMM-yyyy')"


def _padded(number: str, width: int) -> str:
    return f"lpad(cast({number} AS string), {width}, '0')"


def _claim_type(by_priority: list[str], by_status: list[str]) -> str:
    """Seven types: four by order priority, three by status of the low priority."""
    urgent, high, medium, unspecified = by_priority
    final, open_, pending = by_status
    return f"""CASE WHEN o_orderpriority = '1-URGENT' THEN '{urgent}'
        WHEN o_orderpriority = '2-HIGH' THEN '{high}'
        WHEN o_orderpriority = '3-MEDIUM' THEN '{medium}'
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '{unspecified}'
        WHEN o_orderstatus = 'F' THEN '{final}'
        WHEN o_orderstatus = 'O' THEN '{open_}' ELSE '{pending}' END"""


TYPE_KEY = _claim_type(["inpatient", "outpatient", "carrier", "dme"], ["snf", "hospice", "hha"])
TYPE_CODE = _claim_type(["60", "40", "71", "82"], ["20", "50", "10"])


def claim_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed claim headers of all types: one per order."""
    day = "to_date(o_orderdate)"
    amount = _money("o_totalprice")
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat('-', o_custkey) AS bene_id",
        "cast(o_orderkey AS string) AS clm_id",
        f"{TYPE_CODE} AS nch_clm_type_cd",
        f"{TYPE_KEY} AS claim_type_key",
        f"{day} AS clm_from_dt",
        f"date_add({day}, 3) AS clm_thru_dt",
        f"{amount} AS clm_pmt_amt",
        f"cast({amount} + 100 AS decimal(15,2)) AS clm_tot_chrg_amt",
        "concat('Z', left(o_orderpriority, 1), if(o_orderstatus = 'P', '.', ''), o_orderstatus)"
        " AS prncpal_dgns_cd",
        f"{_padded('o_custkey % 50', 2)} AS prvdr_state_cd",
        f"{_padded('o_custkey', 10)} AS org_npi_num",
        f"{day} AS clm_admsn_dt",
        f"date_add({day}, 3) AS nch_bene_dschrg_dt",
        f"{_padded('o_custkey % 1000', 3)} AS clm_drg_cd",
        "day(o_orderdate) AS clm_utlztn_day_cnt",
        "o_orderstatus AS ptnt_dschrg_stus_cd",
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim extract as text: header fields repeated on every line.

    Header text is made on the order side, once per claim, before the join.
    Both sides grow with the data.  The join key is the
    number and not the claim id: whatever groups by claim id afterwards has a
    shuffle of its own, so a hot order can be split over many join tasks."""
    header = claim_headers(spark, sf_dir).selectExpr(
        "o_orderkey",
        "bene_id",
        "clm_id",
        "nch_clm_type_cd",
        "claim_type_key",
        f"{_text_date('clm_from_dt')} AS clm_from_dt",
        f"{_text_date('clm_thru_dt')} AS clm_thru_dt",
        "cast(clm_pmt_amt AS string) AS clm_pmt_amt",
        "cast(clm_tot_chrg_amt AS string) AS clm_tot_chrg_amt",
        "prncpal_dgns_cd",
        "concat(' ', prvdr_state_cd, ' ') AS prvdr_state_cd",
        "org_npi_num",
        f"{_text_date('clm_admsn_dt')} AS clm_admsn_dt",
        f"{_text_date('nch_bene_dschrg_dt')} AS nch_bene_dschrg_dt",
        "clm_drg_cd",
        "cast(clm_utlztn_day_cnt AS string) AS clm_utlztn_day_cnt",
        "if(ptnt_dschrg_stus_cd = 'P', '  ', ptnt_dschrg_stus_cd) AS ptnt_dschrg_stus_cd",
    )
    line = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey",
        "cast(l_linenumber AS string) AS clm_line_num",
        f"{_text_date('to_date(l_shipdate)')} AS rev_cntr_dt",
        "cast(l_partkey AS string) AS hcpcs_cd",
        "cast(cast(l_quantity AS int) AS string) AS rev_cntr_unit_cnt",
        f"cast({_money('l_extendedprice')} AS string) AS rev_cntr_tot_chrg_amt",
    )
    return line.join(header, "o_orderkey").drop("o_orderkey")


def wide_claims(raw: DataFrame) -> DataFrame:
    """The claim extract in the full width of an inpatient one, 194 columns of text.  Columns
    that orders and lines have nothing for are filled from the claim id, its first day and its
    amount, according to their type."""
    filler = {"D": "clm_from_dt", "N": "clm_pmt_amt"}
    return raw.selectExpr(
        *[
            field.name
            if field.name in raw.columns
            else f"{filler.get(field.kind, f"'{i}'" if field.kind in 'IS' else 'concat(%d, clm_id)' % i)} AS {field.name}"
            for i, field in enumerate(INPATIENT)
        ]
    )


def staged_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_header(raw_claims(spark, sf_dir), CLAIM_LAYOUT)


def claim_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim fact straight from the typed headers."""
    return shape_headers(claim_headers(spark, sf_dir))


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person snapshots as text: one per customer and year with an order.

    Covered months come from bit sets of the months that have an order, which
    merge in any order and need no distinct."""
    months = {
        "part_a": "true",
        "part_b": "o_orderstatus = 'F'",
        "hmo": "o_orderstatus = 'O'",
        "dual": "o_orderpriority = '1-URGENT'",
        "part_d": "o_orderstatus IN ('O', 'P')",
    }
    years = (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "o_custkey AS c_custkey",
            "year(o_orderdate) AS yr",
            *[
                f"CASE WHEN {condition} THEN shiftleft(1, month(o_orderdate) - 1) END AS {name}"
                for name, condition in months.items()
            ],
        )
        .groupBy("c_custkey", "yr")
        .agg({name: "bit_or" for name in months})
        .selectExpr(
            "c_custkey", "yr", *[f"bit_count(`bit_or({name})`) AS {name}" for name in months]
        )
    )
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_regionkey")
    persons = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    birth = _text_date("date_add(date'1930-01-01', cast(c_custkey % 20000 AS int))")
    return years.join(persons, "c_custkey").selectExpr(
        "concat('-', c_custkey) AS bene_id",
        "cast(yr AS string) AS bene_enrollmt_ref_yr",
        f"{_padded('c_nationkey', 2)} AS state_code",
        f"{_padded('c_custkey % 1000', 3)} AS county_cd",
        f"{_padded('c_custkey % 100000', 5)} AS zip_cd",
        f"if(c_custkey % 11 = 0, '', {birth}) AS bene_birth_dt",
        "if(c_acctbal < 0, '15-Jun-2001', ' ') AS bene_death_dt",
        "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN '1'"
        " WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN '2' ELSE '9' END AS sex_ident_cd",
        "cast(n_regionkey + 1 AS string) AS rti_race_cd",
        "if(c_custkey % 11 = 0, 'N/A', cast(yr - 1930 AS string)) AS age_at_end_ref_yr",
        "if(c_acctbal > 5000, 'Y', '0') AS esrd_ind",
        "'0' AS entlmt_rsn_orig",
        "cast(yr % 10 AS string) AS entlmt_rsn_curr",
        "cast(least(12, part_a * 6) AS string) AS bene_hi_cvrage_tot_mons",
        "cast(least(12, coalesce(part_b, 0) * 6) AS string) AS bene_smi_cvrage_tot_mons",
        "cast(coalesce(hmo, 0) AS string) AS bene_hmo_cvrage_tot_mons",
        "cast(dual AS string) AS dual_elgbl_mons",
        "cast(least(12, coalesce(part_d, 0) * 6) AS string) AS ptd_plan_cvrg_mons",
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_layout(
        raw_snapshots(spark, sf_dir),
        SNAPSHOT_LAYOUT,
        {"bene_enrollmt_ref_yr": "enrollmt_ref_yr"},
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_beneficiary_dim(snapshots(spark, sf_dir))


def wide_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with diagnosis columns 1..7: a row for each line, whose code is in the
    column of its line number.  Line numbers repeat within an order, so lines aren't
    folded together; a number without a column fails.

    The part behind a line gives its code: sizes up to 15 the stem of the
    brand, larger ones a code no rule knows."""
    positions = range(1, DX_WIDTH + 1)
    stems = ", ".join(f"'{stem}'" for stem in STEMS)
    brand = r"cast(regexp_extract(p_brand, '(\\d+)$', 1) AS int)"
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS l_partkey",
        f"""concat(if(p_size <= 15, element_at(array({stems}), {brand}),
            concat('Z', {_padded(brand, 2)})), cast(p_size % 10 AS string)) AS code""",
    )
    known = f"""if(l_linenumber BETWEEN 1 AND {DX_WIDTH}, l_linenumber, cast(raise_error(
        concat('no diagnosis column for line ', l_linenumber)) AS int))"""
    lines = (
        table(spark, sf_dir, "lineitem")
        .selectExpr("l_orderkey AS o_orderkey", f"{known} AS position", "l_partkey")
        .join(part, "l_partkey")
    )
    ids = ["clm_id", "bene_id", "claim_type_key", "clm_from_dt"]
    return (
        claim_headers(spark, sf_dir)
        .select("o_orderkey", *ids)
        .join(lines, "o_orderkey")
        .selectExpr(
            *ids, *[f"CASE WHEN position = {i} THEN code END AS icd_dgns_cd{i}" for i in positions]
        )
    )


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_codes(
        wide_diagnoses(spark, sf_dir),
        "icd_dgns_cd",
        DX_WIDTH,
        ["clm_id", "bene_id", "claim_type_key", "clm_from_dt"],
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chronic_conditions(diagnoses(spark, sf_dir))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return condition_counts(
        persons(spark, sf_dir), conditions(spark, sf_dir), default_key=DEFAULT_KEY
    )


def raw_pde(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drug event extract as text: one row per event."""
    value = _money("value")
    text = f"cast({value} AS string)"
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS string) AS pde_id",
        "concat('-', user_id) AS bene_id",
        f"{_text_date('to_date(ts)')} AS srvc_dt",
        f"if(event_type = 'error', concat('X', {_padded('user_id', 8)}),"
        f" {_padded('user_id', 11)}) AS prod_srvc_id",
        "event_type AS prscrbr_id",
        "concat('  ', event_type) AS plan_cntrct_rec_id",
        f"if(event_type = 'signup', {text}, cast(floor({value}) AS string)) AS days_suply_num",
        f"{text} AS qty_dspnsd_num",
        r"regexp_extract(props, '(\\d+)', 1) AS fill_num",
        "CASE WHEN event_type IN ('view', 'purchase') THEN 'B'"
        " WHEN event_type IN ('click', 'signup') THEN 'G' ELSE '' END AS brnd_gnrc_cd",
        "CASE WHEN event_type IN ('view', 'click') THEN 'C' WHEN event_type = 'purchase' THEN 'E'"
        " WHEN event_type = 'signup' THEN 'O' ELSE 'X' END AS drug_cvrg_stus_cd",
        f"{text} AS tot_rx_cst_amt",
        f"if(event_type = 'click', 'N/A', {text}) AS ptnt_pay_amt",
        "'0' AS cvrd_d_plan_pd_amt",
        "cast(NULL AS string) AS lics_amt",
    )


def pde(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_layout(raw_pde(spark, sf_dir), PDE_LAYOUT)


def code_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code hierarchy: order under customer under nation under region."""

    def level(name: str, code: str, parent: str, description: str) -> DataFrame:
        return table(spark, sf_dir, name).selectExpr(
            f"{code} AS code", f"{parent} AS parent", f"{description} AS description"
        )

    return (
        level("orders", "concat('O', o_orderkey)", "concat('C', o_custkey)", "o_orderpriority")
        .unionByName(
            level("customer", "concat('C', c_custkey)", "concat('N', c_nationkey)", "c_name")
        )
        .unionByName(
            level("nation", "concat('N', n_nationkey)", "concat('R', n_regionkey)", "n_name")
        )
        .unionByName(level("region", "concat('R', r_regionkey)", "cast(NULL AS string)", "r_name"))
    )


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text as people type it, made from order lines: padded, blank, not a
    number, a decimal where a whole number belongs, impossible dates."""
    day = "to_date(l_shipdate)"
    number = f"cast({_money('l_extendedprice')} AS string)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """CASE WHEN l_orderkey % 7 = 0 THEN '   '
            WHEN l_orderkey % 11 = 0 THEN concat('  ', l_returnflag, ' ')
            ELSE l_returnflag END AS text_in""",
        f"""CASE WHEN l_orderkey % 7 = 0 THEN '' WHEN l_orderkey % 11 = 0 THEN 'N/A'
            WHEN l_orderkey % 13 = 0 THEN concat('31-Feb-', year({day}))
            WHEN l_orderkey % 17 = 0 THEN upper({_text_date(day)})
            WHEN l_orderkey % 19 = 0 THEN date_format({day}, 'd-MMM-yyyy')
            WHEN l_orderkey % 23 = 0 THEN cast({day} AS string)
            ELSE concat(' ', {_text_date(day)}) END AS date_in""",
        f"""CASE WHEN l_orderkey % 7 = 0 THEN ' ' WHEN l_orderkey % 11 = 0 THEN 'N/A'
            WHEN l_orderkey % 13 = 0 THEN concat('-', {number}, '6')
            WHEN l_orderkey % 17 = 0 THEN concat('99999999999999', {number})
            ELSE concat('  ', {number}) END AS numeric_in""",
        """CASE WHEN l_orderkey % 7 = 0 THEN '' WHEN l_orderkey % 11 = 0 THEN 'N/A'
            WHEN l_orderkey % 13 = 0 THEN concat(l_linenumber, '.5')
            WHEN l_orderkey % 17 = 0 THEN concat(' -', l_orderkey, ' ')
            ELSE cast(l_orderkey AS string) END AS int_in""",
    )
