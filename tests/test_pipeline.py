"""The whole load over a generated set of extracts."""

from datetime import date
from decimal import Decimal

import pytest

from claimweave.operators.checks import check_orphans
from claimweave.operators.reports import claims_by_type, diagnosis_by_type, pde_by_status
from claimweave.plans import warehouse
from claimweave.plans.warehouse import Warehouse
from claimweave.sources.layouts import CLAIM_LAYOUTS, CODE_LIST, names
from extracts import YEARS, write_extracts


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("load")
    (folder / "in").mkdir()
    write_extracts(folder / "in")
    w = Warehouse(spark, str(folder / "in"), str(folder / "out"), years=YEARS)
    warehouse.run_pipeline(w)
    return w


def test_raw_keeps_text(built, rows_of):
    raw = built.read("raw", "beneficiary_2016")
    assert set(dict(raw.dtypes).values()) == {"string"}
    assert rows_of(raw, "bene_id", "state_code") == [("-1", "02"), ("-3", "")]
    assert rows_of(built.read("raw", "inpatient").where("clm_id = '101'"), "prvdr_num") == [
        ('A|B "x"',), ('A|B "x"',),
    ]


def test_staging_persons(built, rows_of):
    persons = built.read("staging", "beneficiary")
    assert len(persons.columns) == 186
    assert rows_of(
        persons, "bene_id", "enrollmt_ref_yr", "state_code", "bene_birth_dt",
        "bene_hi_cvrage_tot_mons",
    ) == [
        ("-1", 2015, "01", date(1939, 8, 16), 12), ("-1", 2016, "02", date(1939, 8, 16), 11),
        ("-2", 2015, "05", date(1940, 8, 5), None), ("-2", None, "06", date(1940, 8, 5), None),
        ("-3", 2016, None, None, None), ("-4", 2025, "10", None, 3),
    ]


def test_split(built, rows_of):
    for name, layout in CLAIM_LAYOUTS.items():
        raw = built.read("raw", name)
        header, line = (built.read("staging", f"{name}_{part}") for part in ("header", "line"))
        assert header.count() == raw.select("clm_id").distinct().count()
        assert line.count() == raw.count()
        assert len(header.columns) + len(line.columns) == len(layout) + 3
    header = built.read("staging", "inpatient_header")
    assert rows_of(header, "clm_id", "clm_pmt_amt", "prvdr_state_cd", "prcdr_dt1") == [
        ("100", Decimal("1000.50"), "05", date(2015, 2, 2)),
        ("101", Decimal("200.01"), None, None),
    ]
    line = built.read("staging", "inpatient_line")
    assert rows_of(line, "clm_id", "line_num", "hcpcs_cd") == [
        ("100", 1, "H1"), ("100", 2, "H2"), ("100", 3, "H3"), ("101", 10, "H10"),
        ("101", 2, "H2"),
    ]


def test_persons(built, rows_of):
    dim = built.read("mart", "dim_beneficiary")
    assert rows_of(
        dim, "bene_id", "state_code", "sex_desc", "race_desc", "is_alive", "years_in_data"
    ) == [
        ("-1", "02", "Male", "White", True, 2), ("-2", "06", "Female", "Hispanic", True, 2),
        ("-3", None, "Unknown", "American Indian/Alaska Native", False, 1),
        ("-4", "10", "Female", "Black", True, 1),
    ]


def test_diagnosis_widths(built, rows_of):
    got = rows_of(built.read("mart", "fact_claim_diagnosis"), "clm_id", "dgns_position", "icd_dgns_cd")
    assert got == sorted([
        ("100", 1, "E1165"), ("100", 2, "E119"), ("100", 25, "I10"), ("101", 1, "N183"),
        ("200", 1, "E11"), ("200", 2, "E11"), ("200", 3, "Z00"), ("201", 1, "I10"),
        ("300", 8, "E66"),  # position 9 of a carrier claim is not taken
        ("301", 1, "N18"), ("301", 2, "E119"), ("400", 5, "E100"),  # nor 6 of a dme claim
        ("500", 25, "N189"), ("600", 6, "N182"),  # nor 7 of a hospice claim
        ("700", 1, "C50"),
    ], key=lambda row: [(v is None, str(v)) for v in row])


def test_conditions(built, rows_of):
    got = rows_of(
        built.read("mart", "bene_chronic_conditions"), "bene_id", "condition", "inpatient_count",
        "outpatient_count", "meets_ccw_criteria",
    )
    assert got == [
        ("-1", "cancer_breast", 0, 1, False),
        ("-1", "ckd", 0, 2, True),  # snf and hospice count as outpatient
        ("-1", "diabetes", 2, 0, True),  # E1165 and E119
        ("-1", "diabetes_comp", 1, 0, True),  # E1165 lies inside E11 as well
        ("-1", "hypertension", 1, 0, True),
        ("-2", "diabetes", 0, 2, True),  # two positions of one claim
        ("-2", "hypertension", 0, 1, False),
        ("-3", "ckd", 1, 0, True),
        ("-4", "ckd", 0, 1, False),
        ("-4", "diabetes", 0, 2, True),
        ("-99", "obesity", 0, 1, False),
    ]
    assert rows_of(built.read("mart", "bene_condition_count")) == [
        ("-1", 4, "4", 4, 20141118, "Male"), ("-2", 1, "1", 1, 20150505, "Female"),
        ("-3", 1, "1", 1, 20160303, "Unknown"), ("-4", 1, "1", 1, 20150708, "Female"),
    ]


def test_claim_fact(built, rows_of):
    claims = built.read("mart", "fact_claim_header")
    assert rows_of(claims, "clm_id", "claim_type_key", "condition_group", "condition_sort_order") == [
        ("100", "inpatient", "4", 4), ("101", "inpatient", "1", 1), ("200", "outpatient", "1", 1),
        ("201", "outpatient", "1", 1), ("300", "carrier", None, 0), ("301", "carrier", "1", 1),
        ("400", "dme", "1", 1), ("500", "snf", "4", 4), ("600", "hospice", "4", 4),
        ("700", "hha", "4", 4),
    ]
    totals = {r.claim_type_key: (r.claims, r.total_pmt) for r in claims_by_type(claims).collect()}
    assert totals["inpatient"] == (2, 1201) and totals["carrier"] == (2, 61)
    cohort = built.read("mart", "ckd_diabetes_cost")
    assert rows_of(cohort.groupBy("patient_group").count()) == [
        ("CKD + Diabetes", 4), ("CKD only", 1), ("Diabetes only", 4),
    ]
    by_type = {r.claim_type_key: r for r in diagnosis_by_type(
        built.read("mart", "fact_claim_diagnosis")).collect()}
    assert tuple(by_type["outpatient"])[1:] == (4, 2, 3)


def test_drug_events(built, rows_of):
    fact = built.read("mart", "fact_pde")
    assert rows_of(fact, "pde_id", "srvc_date_key", "qty_dspnsd_num", "fill_num", "brnd_gnrc_cd") == [
        ("1", 20160101, Decimal("30.125"), None, "B"), ("2", 20160102, None, None, "G"),
        ("3", None, None, None, None),
    ]
    assert rows_of(pde_by_status(fact), "drug_cvrg_stus_cd", "description", "total_cost") == [
        ("C", "Covered by Part D", 12), ("E", "Supplemental", None), ("X", "Unknown", 1),
    ]


def results(frame, label="table_name"):
    return {row[label]: row["result"] for row in frame.collect()}


def test_raw_checks(built):
    found = warehouse.raw_checks(built)
    assert set(results(found["row_counts"]).values()) == {"MISMATCH"}
    assert set(results(found["bene_id_nulls"]).values()) == {"OK"}
    assert results(found["bene_id_sign"]) == {"beneficiary_2025": "OK"}
    assert results(found["pde_id_unique"]) == {"pde": "OK"}
    assert results(found["bene_id_linked"]) == {"inpatient": "UNMATCHED", "pde": "UNMATCHED"}
    assert {r.date_format_detected for r in found["birth_date_format"].collect()} == {
        "Unknown format"}
    for frame in found.values():
        assert frame.count() > 0


def test_staging_checks(built):
    found = warehouse.staging_checks(built)
    assert {"inpatient_profile", "outpatient_profile", "carrier_profile"} <= found.keys()
    assert "null_clm_admsn_dt" in found["inpatient_profile"].columns
    assert "null_clm_admsn_dt" not in found["carrier_profile"].columns
    assert "total_pmt_amt" in found["claim_verdicts"].columns
    verdicts = results(found["claim_verdicts"])
    assert verdicts["dme"] == "OK" and verdicts["hospice"] == "CHECK DETAILS"
    assert set(results(found["orphans"], "claim_type").values()) == {"OK"}
    assert results(found["totals"]) == {"inpatient": "MISMATCH", "carrier": "OK", "pde": "OK"}
    # claim 101 has no line 1, so the first lines miss its amount
    assert results(found["fan_trap"]) == {"inpatient": "MISMATCH"}
    linked = results(found["bene_id_linked"])
    assert linked["inpatient_header"] == "OK" and linked["pde"].startswith("UNMATCHED")
    for frame in found.values():
        assert frame.count() > 0


def test_mart_keys_are_unique(built):
    found = {}
    for frame in warehouse.mart_checks(built).values():
        found |= results(frame)
    # the snapshot without a year has an incomplete key
    assert found.pop("fact_enrollment") == "DUPLICATES FOUND"
    assert len(found) == 7 and set(found.values()) == {"OK"}


def test_codes(built, spark, tmp_path):
    tree = [("19", None, "chapter"), ("E08-E13", "19", "block"), ("E11", "E08-E13", "Type 2"),
            ("E119", "E11", "plain"), ("E1165", "E11", "high, with comma"), ("I10", "19", ""),
            ("E11", "19", "listed again"), ("E119", "E11", "plain")]
    codes = spark.createDataFrame(
        [(*row, i) for i, row in enumerate(tree)],
        "code string, parent string, description string, position int",
    )
    skipped = warehouse.extract_code_list(codes, str(tmp_path))
    assert tuple(skipped.first()) == (8, 6, 2)
    extra = spark.createDataFrame([("N18", "added by hand")], "icd_dgns_cd string, description string")
    warehouse.load_codes(built, str(tmp_path / "icd10cm_csv"), extra)
    dim = built.read("mart", "dim_diagnosis")
    assert set(names(CODE_LIST)) < set(dim.columns)
    row = dim.where("icd_dgns_cd = 'E1165'").first()
    assert (row.description, row.is_billable) == ("high, with comma", True)
    assert (row.parent_code, row.block_code, row.chapter_num) == ("E11", "E08-E13", "19")
    checks = warehouse.code_checks(built)
    assert tuple(checks["code_coverage"].first())[:2] == (12, 5)


def test_rerun_replaces_tables(built):
    before = built.read("mart", "bene_condition_count").count()
    warehouse.load_mart(built)
    assert built.read("mart", "bene_condition_count").count() == before


def test_orphans_show_up(built):
    header = built.read("staging", "carrier_header").where("clm_id <> '301'")
    got = check_orphans({"carrier": (built.read("staging", "carrier_line"), header)}, "clm_id")
    assert [tuple(r) for r in got.collect()] == [("carrier", 2, "ORPHANS FOUND")]
