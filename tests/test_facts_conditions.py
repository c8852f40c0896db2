import random
from datetime import date

from pyspark.sql import functions as F

from claimweave.operators.cohorts import (
    cohort_claims,
    cohort_members,
    condition_counts,
    denormalize,
    tag_claims,
)
from claimweave.operators.conditions import (
    CCW_RULES,
    Condition,
    chronic_conditions,
    prefix_join,
    rule_table,
)
from claimweave.operators.facts import (
    CLAIM_COLUMNS,
    build_enrollment,
    shape_headers,
    union_headers,
    unpivot_codes,
)
from claimweave.operators.reports import kpi_cards, slice_counts, top_conditions


def test_enrollment_flags(spark, rows_of):
    snapshots = spark.createDataFrame(
        [("a", 2024, 12, 11, 0, None, 12), ("b", 2025, None, 12, 1, 0, 3), ("c", None, 0, 0, 0, 0, 0)],
        """bene_id string, enrollmt_ref_yr smallint, bene_hi_cvrage_tot_mons smallint,
        bene_smi_cvrage_tot_mons smallint, bene_hmo_cvrage_tot_mons smallint,
        dual_elgbl_mons smallint, ptd_plan_cvrg_mons smallint""",
    )
    flags = ["bene_id", "is_full_year_part_a", "is_full_year_part_b", "is_full_year_part_d",
             "is_any_dual_eligible", "is_any_hmo", "is_partial_year"]
    assert rows_of(build_enrollment(snapshots), *flags) == [
        ("a", True, False, True, None, False, False),
        ("b", None, True, False, False, True, True),
        ("c", False, False, False, False, False, False),
    ]


def full_headers(spark, claim_type):
    kinds = {k: v for k, v in CLAIM_COLUMNS.items() if not k.endswith("_key")}
    values = {
        "string": F.lit("x"), "date": F.lit("2020-02-03").cast("date"),
        "int": F.lit(3), "decimal(15,2)": F.lit(7).cast("decimal(15,2)"),
    }
    return spark.range(2).select(*[values[kind].alias(name) for name, kind in kinds.items()])


def test_union_and_single_pass_agree(spark, rows_of):
    types = ["inpatient", "outpatient", "carrier", "dme", "snf", "hospice", "hha"]
    parts = {t: full_headers(spark, t) for t in types}
    union = union_headers(parts)
    assert dict(union.dtypes) == CLAIM_COLUMNS
    assert union.count() == 14
    tagged = [df.withColumn("claim_type_key", F.lit(t)) for t, df in parts.items()]
    stacked = tagged[0]
    for df in tagged[1:]:
        stacked = stacked.unionByName(df)
    assert rows_of(shape_headers(stacked)) == rows_of(union)
    filled = {
        r.claim_type_key: {c for c in CLAIM_COLUMNS if r[c] is not None} for r in union.collect()
    }
    optional = {c for c in CLAIM_COLUMNS if c not in filled["carrier"]}
    assert filled["inpatient"] - filled["carrier"] == optional and len(optional) == 8
    assert filled["inpatient"] - filled["outpatient"] == {
        "clm_admsn_dt", "nch_bene_dschrg_dt", "clm_drg_cd", "clm_utlztn_day_cnt"}
    assert filled["inpatient"] - filled["hospice"] == {"clm_admsn_dt", "clm_drg_cd"}
    assert filled["inpatient"] - filled["hha"] == {
        "nch_bene_dschrg_dt", "clm_drg_cd", "clm_utlztn_day_cnt"}
    assert filled["dme"] == filled["carrier"] and filled["snf"] == filled["inpatient"]


def test_unpivot_keeps_every_filled_cell(spark, rows_of):
    wide = spark.createDataFrame(
        [("1", "A", None, "A"), ("2", None, None, None), ("3", None, "B", None)],
        "id string, dx1 string, dx2 string, dx3 string",
    )
    assert rows_of(unpivot_codes(wide, "dx", 3, ["id"])) == [
        ("1", "A", 1), ("1", "A", 3), ("3", "B", 2),
    ]
    assert rows_of(unpivot_codes(wide, "dx", 1, ["id"])) == [("1", "A", 1)]


def test_rules(spark):
    assert rule_table(spark).count() == 44
    assert len(CCW_RULES) == 21


def test_prefix_join_against_starts_with(spark, rows_of):
    rules = {
        "one": Condition("One", ("E", "E11")),
        "two": Condition("Two", ("E116", "E1")),
        "exact": Condition("Exact", ("I10",)),
    }
    codes = ["E", "E1", "E11", "E116", "E1165", "I10", "I1", "I100", "Z", "", None]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    expected = [
        (c, name, p) for c in codes if c is not None
        for name, rule in rules.items() for p in rule.prefixes if c.startswith(p)
    ]
    got = rows_of(prefix_join(df, "code", rules), "code", "condition", "icd_cd_prefix")
    assert got == sorted(expected)


def diagnoses(spark, n=4000, seed=5):
    rnd = random.Random(seed)
    codes = ["E119", "E1165", "I10", "N183", "Z00", "F329", "C61"]
    types = ["inpatient", "outpatient", "carrier"]
    rows = [
        (f"c{i}", "hot" if i % 3 == 0 else f"p{rnd.randrange(900)}", rnd.choice(types),
         date(2015, 1, 1 + rnd.randrange(28)), rnd.choice(codes))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(
        rows, "clm_id string, bene_id string, claim_type_key string, clm_from_dt date, "
        "icd_dgns_cd string",
    )


def test_conditions_against_brute_force(spark, rows_of):
    rows, df = diagnoses(spark)
    expected = {}
    for _, bene, kind, day, code in rows:
        for name, rule in CCW_RULES.items():
            for prefix in rule.prefixes:
                if code.startswith(prefix):
                    expected.setdefault((bene, name), []).append((day, kind))
    got = chronic_conditions(df).collect()
    assert len(got) == len(expected)
    for r in got:
        hits = expected[r.bene_id, r.condition]
        days = [d for d, _ in hits]
        inside = sum(kind == "inpatient" for _, kind in hits)
        assert (r.first_claim_dt, r.last_claim_dt) == (min(days), max(days))
        assert (r.claim_count, r.inpatient_count) == (len(hits), inside)
        assert r.outpatient_count == len(hits) - inside
        assert r.meets_ccw_criteria == (inside >= 1 or len(hits) - inside >= 2)
        assert r.first_claim_date_key == int(min(days).strftime("%Y%m%d"))
        assert r.condition_desc == CCW_RULES[r.condition].label


def test_rules_are_hashed_not_looped(spark):
    _, df = diagnoses(spark, 50)
    plan = chronic_conditions(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


CONDITION = """bene_id string, condition string, condition_desc string,
    meets_ccw_criteria boolean, first_claim_date_key int"""


def conditions(spark):
    return spark.createDataFrame(
        [("a", "ckd", "CKD", True, 20160101), ("a", "diabetes", "DM", True, 20150601),
         ("b", "ckd", "CKD", False, 20150101), ("b", "diabetes", "DM", True, 20170101),
         ("c", "ckd", "CKD", True, 20160101), ("d", "afib", "AF", True, 20160101)]
        + [("e", f"x{i}", f"X{i}", True, 20160101 + i) for i in range(9)],
        CONDITION,
    )


def persons(spark):
    return spark.createDataFrame(
        [(p, "Male" if p in "ace" else "Female") for p in "abcdef"],
        "bene_id string, sex_desc string",
    )


def test_counts_and_buckets(spark, rows_of):
    counts = condition_counts(persons(spark), conditions(spark))
    assert rows_of(counts) == [
        ("a", 2, "2", 2, 20150601, "Male"), ("b", 1, "1", 1, 20170101, "Female"),
        ("c", 1, "1", 1, 20160101, "Male"), ("d", 1, "1", 1, 20160101, "Female"),
        ("e", 9, "7+", 7, 20160101, "Male"), ("f", 0, "0", 0, 20150101, "Female"),
    ]
    assert [tuple(map(float, r)) for r in kpi_cards(counts).collect()] == [(6, 5, 83.3, 2.8, 1)]
    calendar = spark.createDataFrame([(20160101, 2016), (20150101, 2015)], "date_key int, year int")
    assert rows_of(slice_counts(counts, calendar, year=2016, sex="Male"), "bene_id") == [
        ("c",), ("e",),
    ]


def test_top_conditions_break_ties_by_name(spark):
    top = top_conditions(conditions(spark), 3).collect()
    assert [tuple(r) for r in top] == [("CKD", 2), ("DM", 2), ("AF", 1)]


CLAIM = """clm_id string, bene_id string, claim_type_key string, clm_pmt_amt decimal(15,2),
    from_date_key int"""


def test_tagging_keeps_all_claims(spark, rows_of):
    claims = spark.createDataFrame(
        [("1", "a", "snf", None, 1), ("2", "zz", "snf", None, 1), ("3", "f", "snf", None, 1),
         ("4", None, "snf", None, 1)], CLAIM)
    tagged = tag_claims(claims, condition_counts(persons(spark), conditions(spark)))
    assert rows_of(tagged, "clm_id", "condition_group", "condition_sort_order") == [
        ("1", "2", 2), ("2", None, 0), ("3", "0", 0), ("4", None, 0),
    ]
    assert rows_of(denormalize(claims, persons(spark), "bene_id", ["sex_desc"]), "clm_id",
                   "sex_desc") == [("1", "Male"), ("2", None), ("3", "Female"), ("4", None)]


def test_cohorts(spark, rows_of):
    claims = spark.createDataFrame(
        [(str(i), p, "snf", None, 1) for i, p in enumerate("aabcdz")], CLAIM)
    cohort = cohort_claims(claims, cohort_members(conditions(spark)))
    assert rows_of(cohort, "bene_id", "patient_group") == [
        ("a", "CKD + Diabetes"), ("a", "CKD + Diabetes"), ("b", "Diabetes only"),
        ("c", "CKD only"),
    ]
