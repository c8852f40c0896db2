"""The whole load: extracts to raw, staging and mart tables, and checks of each layer.

Every table is written once and read back from Parquet by the steps after it,
so no step recomputes another and a lost executor costs at most the tasks of
one step.  Each load rebuilds all tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.casts import safe_to_numeric
from claimweave.operators import checks, reports
from claimweave.operators.checks import Seen, Source, Split, Total
from claimweave.operators.cohorts import (
    cohort_claims,
    cohort_members,
    condition_counts,
    tag_claims,
)
from claimweave.operators.conditions import CCW_RULES, Rules, chronic_conditions
from claimweave.operators.dimensions import (
    CLAIM_TYPES,
    build_beneficiary_dim,
    build_calendar,
    build_diagnosis_dim,
    claim_type_dim,
    flatten_hierarchy,
)
from claimweave.operators.facts import (
    build_enrollment,
    build_pde_fact,
    diagnosis_fact,
    union_headers,
)
from claimweave.operators.keys import dedupe_first
from claimweave.operators.staging import split_header, split_line, stage_pde, stage_snapshots
from claimweave.sources.files import (
    read_code_list,
    read_table,
    read_text_table,
    with_load_date,
    write_bucketed,
    write_part,
    write_table,
)
from claimweave.sources.layouts import BENEFICIARY, CLAIM_LAYOUTS, PDE, Field, line_key, names

TYPE_CODES = {claim_type: type_code for claim_type, *_, type_code in CLAIM_TYPES}

# Published row counts of the public extracts.
RAW_ROWS = {
    "inpatient": 58066,
    "outpatient": 575092,
    "carrier": 1121004,
    "dme": 103828,
    "snf": 12548,
    "hospice": 12107,
    "hha": 6215,
    "pde": 515520,
}
HEADER_ROWS = {
    "inpatient": 20867,
    "outpatient": 402653,
    "carrier": 90705,
    "dme": 37782,
    "snf": 1632,
    "hospice": 1086,
    "hha": 493,
}
SNAPSHOT_ROWS = {
    "2015": 5975,
    "2016": 6288,
    "2017": 6613,
    "2018": 7002,
    "2019": 7446,
    "2020": 7837,
    "2021": 8246,
    "2022": 8671,
    "2023": 9179,
    "2024": 9660,
    "2025": 10000,
}


#: The extract that a row of the person snapshots came with; not a column of its layout.
LOAD_YEAR = "load_year"

#: What was seen of tables while they were written, by layer and name.
Written = Mapping[tuple[str, str], Mapping[str, object]]


class Warehouse(NamedTuple):
    """Where the layers live, and how the extracts are found."""

    spark: SparkSession
    source: str
    root: str
    years: Sequence[int] = tuple(range(2015, 2026))
    partial_years: Sequence[int] = (2025,)
    first_day: str = "2014-01-01"
    last_day: str = "2025-12-31"
    rules: Rules = CCW_RULES

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/{layer}", name).drop(LOAD_YEAR)

    def write(
        self, layer: str, name: str, df: DataFrame, measures: Sequence[Column] = (), partition_by: str | None = None
    ) -> dict[str, object]:
        return write_table(df, f"{self.root}/{layer}", name, measures=measures, partition_by=partition_by)

    def stamp(
        self, layer: str, name: str, df: DataFrame, measures: Sequence[Column] = (), partition_by: str | None = None
    ) -> dict[str, object]:
        return self.write(layer, name, with_load_date(df), measures, partition_by)


def snapshot_extract(w: Warehouse, year: int) -> DataFrame:
    return read_text_table(w.spark, f"{w.source}/beneficiary_{year}.csv", names(BENEFICIARY), check_header=True)


def load_raw(w: Warehouse) -> Written:
    """Extracts as they are, every column text; returns what the checks want to know."""
    seen = {}
    for name, layout in {**CLAIM_LAYOUTS, "pde": PDE}.items():
        extract = read_text_table(w.spark, f"{w.source}/{name}.csv", names(layout), check_header=True)
        seen["raw", name] = w.write("raw", name, extract, [checks.nulls("bene_id")])
    for year in w.years:
        name = f"beneficiary_{year}"
        seen["raw", name] = w.write("raw", name, snapshot_extract(w, year))
    return seen


def load_staging(w: Warehouse) -> Written:
    """Typed persons, claim headers and lines, and drug events; returns what the checks
    want to know.  The persons are stored by the year of their extract."""
    seen = {}
    yearly = w.spark.read.parquet(*[f"{w.root}/raw/beneficiary_{year}" for year in w.years])
    came_with = F.regexp_extract("_metadata.file_path", r"/beneficiary_(\d+)/", 1)
    snapshots = stage_snapshots(yearly.select("*", came_with.alias(LOAD_YEAR)), layout=(*BENEFICIARY, Field(LOAD_YEAR, "I")))
    measures = checks.observable(checks.person_measures())
    seen["staging", "beneficiary"] = w.stamp("staging", "beneficiary", snapshots, measures, LOAD_YEAR)
    for name, layout in CLAIM_LAYOUTS.items():
        raw, header = w.read("raw", name), f"{name}_header"
        split = split_header(raw, layout)
        measures = checks.observable(checks.claim_measures(split.columns, TYPE_CODES[name]))
        seen["staging", header] = w.stamp("staging", header, split, measures)
        seen["staging", f"{name}_line"] = w.stamp("staging", f"{name}_line", split_line(raw, layout))
    measures = checks.observable(checks.pde_measures())
    seen["staging", "pde"] = w.stamp("staging", "pde", stage_pde(w.read("raw", "pde")), measures)
    return seen


def load_year(w: Warehouse, year: int) -> None:
    """Load the person snapshots of one year, again or for the first time; those of other
    years stay as they are.  The mart isn't touched."""
    w.write("raw", f"beneficiary_{year}", snapshot_extract(w, year))
    staged = with_load_date(stage_snapshots(w.read("raw", f"beneficiary_{year}")))
    write_part(staged.withColumn(LOAD_YEAR, F.lit(year)), f"{w.root}/staging", "beneficiary", LOAD_YEAR, year)


def load_mart(w: Warehouse) -> None:
    """Dimensions, facts, chronic conditions and the tables built on them.

    The claim fact is written last, because the condition bucket of the person
    is joined on before its only write."""
    snapshots = w.read("staging", "beneficiary")
    headers = {name: w.read("staging", f"{name}_header") for name in CLAIM_LAYOUTS}

    w.write("mart", "dim_date", build_calendar(w.spark, w.first_day, w.last_day))
    w.write("mart", "dim_claim_type", claim_type_dim(w.spark))
    w.stamp("mart", "dim_beneficiary", build_beneficiary_dim(snapshots))
    w.write("mart", "fact_enrollment", build_enrollment(snapshots, w.partial_years))
    w.stamp("mart", "fact_claim_diagnosis", diagnosis_fact(headers))
    w.stamp("mart", "fact_pde", build_pde_fact(w.read("staging", "pde")))

    diagnoses = w.read("mart", "fact_claim_diagnosis")
    w.stamp("mart", "bene_chronic_conditions", chronic_conditions(diagnoses, w.rules))
    conditions = w.read("mart", "bene_chronic_conditions")
    persons = w.read("mart", "dim_beneficiary")
    w.write("mart", "bene_condition_count", condition_counts(persons, conditions))
    counts = w.read("mart", "bene_condition_count")
    w.stamp("mart", "fact_claim_header", tag_claims(union_headers(headers), counts))
    claims = w.read("mart", "fact_claim_header")
    w.write("mart", "ckd_diabetes_cost", cohort_claims(claims, cohort_members(conditions)))


def extract_code_list(codes: DataFrame, target: str, name: str = "icd10cm_csv") -> DataFrame:
    """Flatten a ``(code, parent, description, position)`` tree and write it as CSV.

    Of a code that is listed more than once the first by ``position`` counts; the
    result says how many were skipped."""
    tree = dedupe_first(codes, "code", "position").select("code", "parent", "description")
    write_table(flatten_hierarchy(tree), target, name, fmt="csv")
    return checks.duplicates_skipped(codes, "code")


def load_codes(w: Warehouse, path: str, extra: DataFrame | None = None) -> None:
    """Diagnosis dimension from the code list file, plus codes it lacks."""
    w.stamp("mart", "dim_diagnosis", build_diagnosis_dim(read_code_list(w.spark, path), extra))


def _source(w: Warehouse, layer: str, name: str, seen: Written) -> Source:
    table = w.read(layer, name)
    return Seen(table, seen[layer, name]) if (layer, name) in seen else table


def bucket_tables(w: Warehouse, buckets: int, database: str = "default") -> dict[str, DataFrame]:
    """Copies of the tables that are joined by person or by claim, in so many buckets: the
    claim fact, the condition counts and the cohort members by person, headers and lines by claim.

    With these, tagging, cohorts and the check for orphans shuffle no claims
    (``colocated=True``).  About 200 MB a bucket is a good size, and a power of two lets tables
    of different sizes share buckets.  Buckets can't split a person who owns a large share
    of the claims; the load itself joins by ``lookup``, which can."""
    members = cohort_members(w.read("mart", "bene_chronic_conditions"))
    tables = {
        "claims_by_person": (w.read("mart", "fact_claim_header"), "bene_id"),
        "counts_by_person": (w.read("mart", "bene_condition_count"), "bene_id"),
        "cohorts_by_person": (members, "bene_id"),
    }
    for name in CLAIM_LAYOUTS:
        for part in ("header", "line"):
            tables[f"{name}_{part}_by_claim"] = (w.read("staging", f"{name}_{part}"), "clm_id")
    return {
        name: write_bucketed(df, f"{database}.{name}", f"{w.root}/buckets/{name}", key, buckets)
        for name, (df, key) in tables.items()
    }


def raw_checks(w: Warehouse, seen: Written = MappingProxyType({})) -> dict[str, DataFrame]:
    """The checks of the raw layer.  Those that only count rows read nothing of tables that
    were ``seen`` being written."""
    claims = {name: w.read("raw", name) for name in CLAIM_LAYOUTS}
    pde = w.read("raw", "pde")
    latest = w.read("raw", f"beneficiary_{w.years[-1]}")
    yearly = {str(year): _source(w, "raw", f"beneficiary_{year}", seen) for year in w.years}
    files = {name: _source(w, "raw", name, seen) for name in (*CLAIM_LAYOUTS, "pde")}
    linked = {"inpatient": claims["inpatient"], "pde": pde}
    return {
        "row_counts": checks.check_row_counts(files, RAW_ROWS),
        "snapshot_counts": checks.check_row_counts(yearly, SNAPSHOT_ROWS),
        "bene_id_nulls": checks.check_nulls(files, "bene_id"),
        "clm_id_fanout": checks.check_key_fanout(claims, "clm_id"),
        "bene_id_sign": checks.check_id_sign(latest, f"beneficiary_{w.years[-1]}", "bene_id"),
        "birth_date_format": checks.classify_date_format(latest, "bene_birth_dt"),
        "amounts": checks.check_amounts(claims, "clm_pmt_amt"),
        "pde_id_unique": checks.check_unique(pde, "pde", "pde_id"),
        "leading_zeros": checks.check_lengths(latest, ["state_code", "zip_cd"], "state_code", 2),
        "bene_id_linked": checks.check_ref(linked, "bene_id", latest),
    }


def staging_checks(w: Warehouse, seen: Written = MappingProxyType({})) -> dict[str, DataFrame]:
    """The checks of the staging layer.  Of tables that were ``seen`` being written, row counts
    and the split read nothing, and profiles only the columns of distinct counts."""
    raw = {name: w.read("raw", name) for name in CLAIM_LAYOUTS}
    headers = {name: w.read("staging", f"{name}_header") for name in CLAIM_LAYOUTS}
    lines = {name: w.read("staging", f"{name}_line") for name in CLAIM_LAYOUTS}
    snapshots, pde = w.read("staging", "beneficiary"), w.read("staging", "pde")

    def first_lines(name: str) -> Total:
        on_first = F.col(line_key(CLAIM_LAYOUTS[name])) == "1"
        return Total(raw[name].where(on_first), safe_to_numeric("clm_pmt_amt"))

    def header_total(name: str) -> Total:
        return Total(headers[name], F.col("clm_pmt_amt"))

    parts = [f"{name}_{part}" for part in ("header", "line") for name in CLAIM_LAYOUTS]
    staged = {name: _source(w, "staging", name, seen) for name in ("beneficiary", *parts, "pde")}
    expected = {
        "beneficiary": sum(SNAPSHOT_ROWS.values()),
        **{f"{name}_header": rows for name, rows in HEADER_ROWS.items()},
        **{f"{name}_line": RAW_ROWS[name] for name in CLAIM_LAYOUTS},
        "pde": RAW_ROWS["pde"],
    }
    profiles = {
        name: checks.claim_profile(staged[f"{name}_header"], name, TYPE_CODES[name]) for name in CLAIM_LAYOUTS
    }
    return {
        "row_counts": checks.check_row_counts(staged, expected),
        "snapshots": checks.snapshot_summary(snapshots),
        "split": checks.check_split(
            {
                name: Split(_source(w, "raw", name, seen), staged[f"{name}_header"], staged[f"{name}_line"])
                for name in CLAIM_LAYOUTS
            },
            HEADER_ROWS,
            RAW_ROWS,
        ),
        "fan_trap": checks.check_fan_trap(
            header_total("inpatient"), first_lines("inpatient"), "inpatient"
        ),
        "person_profile": checks.person_profile(staged["beneficiary"]),
        **{f"{name}_profile": profiles[name] for name in ("inpatient", "outpatient", "carrier")},
        "claim_verdicts": checks.claim_verdicts(list(profiles.values())),
        "pde_profile": checks.pde_profile(staged["pde"]),
        "orphans": checks.check_orphans(
            {name: (lines[name], headers[name]) for name in CLAIM_LAYOUTS}, "clm_id"
        ),
        "bene_id_linked": checks.check_ref(
            {
                "inpatient_header": headers["inpatient"],
                "carrier_header": headers["carrier"],
                "pde": pde,
            },
            "bene_id",
            snapshots,
            bad="UNMATCHED (may span years)",
        ),
        "totals": checks.check_totals(
            {
                "inpatient": (header_total("inpatient"), first_lines("inpatient")),
                "carrier": (header_total("carrier"), first_lines("carrier")),
                "pde": (
                    Total(pde, F.col("tot_rx_cst_amt")),
                    Total(w.read("raw", "pde"), safe_to_numeric("tot_rx_cst_amt")),
                ),
            }
        ),
    }


def mart_checks(w: Warehouse) -> dict[str, DataFrame]:
    """Key uniqueness of the mart tables, which no storage enforces."""
    keyed = {
        "dim_date": "date_key",
        "dim_claim_type": "claim_type_key",
        "dim_beneficiary": "bene_id",
        "fact_enrollment": ("bene_id", "enrollmt_ref_yr"),
        "fact_claim_header": "clm_id",
        "fact_pde": "pde_id",
        "bene_chronic_conditions": ("bene_id", "condition"),
        "bene_condition_count": "bene_id",
    }
    return {
        f"{name}_key": checks.check_unique(w.read("mart", name), name, key)
        for name, key in keyed.items()
    }


def code_checks(w: Warehouse) -> dict[str, DataFrame]:
    """Totals of the code dimension, and how many claimed codes it knows."""
    codes = w.read("mart", "dim_diagnosis")
    diagnoses = w.read("mart", "fact_claim_diagnosis")
    return {
        "code_key": checks.check_unique(codes, "dim_diagnosis", "icd_dgns_cd"),
        "code_totals": reports.code_dim_totals(codes),
        "code_coverage": checks.check_coverage(diagnoses, codes, "icd_dgns_cd"),
    }


def run_pipeline(
    w: Warehouse, code_list: str | None = None, extra_codes: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Load all layers, with the code dimension if a code list is given, and return the
    checks of every layer by ``layer.name``; they run when they are looked at, and read
    nothing again that was counted while it was written."""
    seen = {**load_raw(w), **load_staging(w)}
    load_mart(w)
    found = {"raw": raw_checks(w, seen), "staging": staging_checks(w, seen), "mart": mart_checks(w)}
    if code_list:
        load_codes(w, code_list, extra_codes)
        found["codes"] = code_checks(w)
    return {f"{layer}.{name}": df for layer, frames in found.items() for name, df in frames.items()}
