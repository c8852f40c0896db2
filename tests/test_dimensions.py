from datetime import date, timedelta

import pytest

from claimweave.operators.dimensions import (
    build_beneficiary_dim,
    build_calendar,
    build_diagnosis_dim,
    claim_type_dim,
    flatten_hierarchy,
    snapshot_span,
)
from claimweave.operators.reports import list_claim_types


def test_calendar(spark):
    rows = build_calendar(spark, "2014-01-01", "2025-12-31").orderBy("date_key").collect()
    assert len(rows) == 4383
    for i in (0, 59, 272, 273, 362, 1154, 4382):
        day, row = date(2014, 1, 1) + timedelta(days=i), rows[i]
        assert row.full_date == day and row.date_key == int(day.strftime("%Y%m%d"))
        assert (row.year, row.month, row.day_of_month) == (day.year, day.month, day.day)
        assert row.week_of_year == day.isocalendar().week
        assert row.day_of_week == day.isoweekday() % 7
        assert row.is_weekend == (day.isoweekday() >= 6)
        assert row.month_name == day.strftime("%B").ljust(9)
        assert row.day_name == day.strftime("%A").ljust(9)
        assert row.cms_fiscal_year == day.year + (day.month >= 10)
        assert row.cms_fiscal_quarter == (day.month + 2) // 3 % 4 + 1
        assert row.quarter == (day.month + 2) // 3


def test_claim_types(spark):
    listed = list_claim_types(claim_type_dim(spark)).collect()
    assert [r.claim_type_key for r in listed] == [
        "carrier", "dme", "hha", "hospice", "inpatient", "outpatient", "snf",
    ]
    assert sum(r.is_part_a for r in listed) == 4
    assert all(r.is_part_a != r.is_part_b for r in listed)


SNAPSHOT = """bene_id string, enrollmt_ref_yr smallint, bene_birth_dt date, bene_death_dt date,
    sex_ident_cd string, rti_race_cd string, state_code string, county_cd string, zip_cd string,
    esrd_ind string, entlmt_rsn_orig string, entlmt_rsn_curr string"""


def person(bene, year, state, sex="1", death=None):
    return (bene, year, date(1940, 1, 1), death, sex, "3", state, "c", "z", "0", "0", "1")


def test_beneficiary_dim(spark, rows_of):
    snapshots = spark.createDataFrame(
        [
            person("a", 2015, "01"), person("a", 2017, "03"), person("a", 2016, "02"),
            person("b", 2020, "04", "2"), person("b", None, "05", "2", date(2021, 1, 1)),
            person(None, 2020, "06"),
        ],
        SNAPSHOT,
    )
    dim = build_beneficiary_dim(snapshots)
    columns = ["bene_id", "state_code", "sex_desc", "race_desc", "is_alive",
               "first_year_in_data", "last_year_in_data", "years_in_data"]
    assert rows_of(dim, *columns) == [
        ("a", "03", "Male", "Unknown", True, 2015, 2017, 3),
        ("b", "05", "Female", "Unknown", False, 2020, 2020, 2),
    ]
    assert rows_of(snapshot_span(snapshots.where("bene_id = 'a'"))) == [("a", 2015, 2017, 3)]


TREE = [
    # chapter, block, three-, four- and five-character codes, as in the code book
    ("4", None, "Endocrine"),
    ("E08-E13", "4", "Diabetes"),
    ("E11", "E08-E13", "Type 2"),
    ("E116", "E11", "with other complications"),
    ("E1165", "E116", "with hyperglycemia"),
    ("E119", "E11", "without complications"),
    ("9", None, "a chapter without codes"),
]


def brute_force(tree):
    parent = {code: up for code, up, _ in tree}
    text = {code: desc for code, _, desc in tree}
    out = []
    for code, _, desc in tree:
        chain, up = [], parent[code]
        while up is not None:
            chain.append(up)
            up = parent.get(up)
        top = chain[-1] if chain else None
        second = chain[1] if len(chain) > 1 else None
        near = chain[0] if chain else None
        out.append((code, desc, code not in parent.values(), top, text.get(top), second,
                    text.get(second), near, text.get(near)))
    return out


@pytest.mark.parametrize(
    "tree", [TREE, TREE + [("X1", "gone", "parent is not a code")]], ids=["book", "dangling"]
)
def test_flatten_hierarchy(spark, rows_of, tree):
    codes = spark.createDataFrame(tree, "code string, parent string, description string")
    expected = sorted(brute_force(tree), key=lambda row: [(v is None, str(v)) for v in row])
    assert rows_of(flatten_hierarchy(codes)) == expected


@pytest.mark.parametrize("length", [1, 2, 3, 4, 7])
def test_hierarchy_that_never_ends_fails(spark, length):
    loop = [(f"n{i}", f"n{(i + 1) % length}", "") for i in range(length)]
    tree = [*loop, ("leaf", "n0", ""), ("root", None, ""), ("other", "root", "")]
    codes = spark.createDataFrame(tree, "code string, parent string, description string")
    with pytest.raises(ValueError, match="never ends"):
        flatten_hierarchy(codes).count()


def test_hierarchy_of_many_levels(spark, rows_of):
    deep = [(str(i), str(i - 1) if i else None, f"level {i}") for i in range(13)]
    codes = spark.createDataFrame(deep, "code string, parent string, description string")
    expected = sorted(brute_force(deep), key=lambda row: [(v is None, str(v)) for v in row])
    assert rows_of(flatten_hierarchy(codes)) == expected


def test_code_listed_twice_fails(spark):
    codes = spark.createDataFrame(
        [*TREE, ("E11", "4", "again")], "code string, parent string, description string"
    )
    with pytest.raises(ValueError, match="E11 is listed more than once"):
        flatten_hierarchy(codes).count()
    assert flatten_hierarchy(codes.where("false")).count() == 0


def test_diagnosis_dim_takes_extra_codes(spark, rows_of):
    codes = spark.createDataFrame(
        [("A", "from list", True, "1")], "icd_dgns_cd string, description string, "
        "is_billable boolean, chapter_num string",
    )
    extra = spark.createDataFrame(
        [("A", "from extra"), ("B", "from extra")], "icd_dgns_cd string, description string"
    )
    assert rows_of(build_diagnosis_dim(codes, extra)) == [
        ("A", "from list", True, "1"), ("B", "from extra", None, None),
    ]
    assert rows_of(build_diagnosis_dim(codes)) == [("A", "from list", True, "1")]
