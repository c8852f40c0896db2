"""Replacing tables, loading a year again, and checks that read nothing again."""

import os
import re

import pytest
from pyspark.sql import functions as F

from claimweave.operators import cohorts
from claimweave.operators.checks import check_orphans
from claimweave.plans import warehouse
from claimweave.plans.warehouse import Warehouse
from claimweave.sources.files import (
    _earlier, _rename, read_table, remove, write_part, write_table,
)
from extracts import YEARS, write_extracts


@pytest.fixture
def loaded(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_extracts(tmp_path / "in")
    w = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "out"), years=YEARS)
    return w, {**warehouse.load_raw(w), **warehouse.load_staging(w)}


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_counting_checks_read_no_table_again(loaded):
    w, seen = loaded
    for layer, checks in (("raw", warehouse.raw_checks), ("staging", warehouse.staging_checks)):
        now, again = checks(w, seen), checks(w)
        for name, frame in again.items():
            assert now[name].dtypes == frame.dtypes, name
            assert sorted(map(str, now[name].collect())) == sorted(map(str, frame.collect())), name
        counted = {"raw": ("row_counts", "snapshot_counts", "bene_id_nulls"), "staging": ("row_counts", "split")}[layer]
        for name in counted:
            assert "Scan parquet" not in plan_of(now[name]) and "Scan parquet" in plan_of(again[name])
    # profiles read the one column whose distinct values are counted
    plan = plan_of(warehouse.staging_checks(w, seen)["pde_profile"])
    assert set(re.findall(r"ReadSchema: (\S+)", plan)) == {"struct<prod_srvc_id:string>"}


def test_a_write_that_fails_leaves_the_earlier_table(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(10), root, "t")
    half = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_table(half, root, "t")
    assert read_table(spark, root, "t").count() == 10
    assert os.listdir(root) == ["t"]


def test_a_replacement_that_dies_between_its_renames_is_settled(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(10), root, "t")
    _rename(spark, f"{root}/t", _earlier(root, "t"))
    assert read_table(spark, root, "t").count() == 10
    _rename(spark, f"{root}/t", _earlier(root, "t"))
    write_table(spark.range(3), root, "t")
    assert read_table(spark, root, "t").count() == 3 and os.listdir(root) == ["t"]


def test_a_table_may_be_made_of_itself(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(10), root, "t")
    values = write_table(read_table(spark, root, "t").where("id > 3"), root, "t", measures=[F.sum("id"), F.max("id")])
    assert read_table(spark, root, "t").count() == 6
    assert values == {str(F.count(F.lit(1))): 6, str(F.sum("id")): 39, str(F.max("id")): 9}
    assert write_table(spark.range(0), root, "t", measures=[F.sum("id")]) == {str(F.count(F.lit(1))): 0, str(F.sum("id")): None}


def files_of(folder):
    return {os.path.join(at, name) for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet")}


def test_one_year_is_loaded_again(loaded, spark, rows_of, tmp_path):
    w, _ = loaded
    whole = rows_of(w.read("staging", "beneficiary").drop("dwh_load_date"))
    folder = f"{w.root}/staging/beneficiary"
    first = Warehouse(spark, w.source, str(tmp_path / "later"), years=YEARS[:-1])
    warehouse.load_raw(first)
    warehouse.load_staging(first)
    others = files_of(f"{first.root}/staging/beneficiary")
    for _ in range(2):  # the last year for the first time, then again
        warehouse.load_year(first, YEARS[-1])
        assert rows_of(first.read("staging", "beneficiary").drop("dwh_load_date")) == whole
    assert others < files_of(f"{first.root}/staging/beneficiary")
    assert {name.split("=")[1] for name in os.listdir(folder) if "=" in name} == {str(year) for year in YEARS}
    # an extract that lost its rows leaves none of that year
    path = f"{w.source}/beneficiary_{YEARS[0]}.csv"
    with open(path) as file:
        header = file.readline()
    with open(path, "w") as file:
        file.write(header)
    warehouse.load_year(w, YEARS[0])
    left = rows_of(w.read("staging", "beneficiary").drop("dwh_load_date"))
    assert 0 < len(left) < len(whole) and set(map(str, left)) < set(map(str, whole))


def test_rows_of_another_part_are_refused(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(4).selectExpr("id", "id % 2 AS part"), root, "t", partition_by="part")
    with pytest.raises(Exception, match="another part"):
        write_part(spark.range(4).selectExpr("id", "id % 2 AS part"), root, "t", "part", 1)
    assert read_table(spark, root, "t").count() == 4
    write_part(spark.range(9).selectExpr("id", "1 AS part"), root, "t", "part", 1)
    assert read_table(spark, root, "t").groupBy("part").count().orderBy("part").collect() == [(0, 2), (1, 9)]
    remove(spark, f"{root}/t")


def test_joins_of_tables_in_buckets_shuffle_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_extracts(tmp_path / "in")
    w = Warehouse(spark, str(tmp_path / "in"), str(tmp_path / "out"), years=YEARS)
    warehouse.run_pipeline(w)
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets")
    tables = warehouse.bucket_tables(w, 4, "buckets")
    claims, counts, members = (tables[f"{name}_by_person"] for name in ("claims", "counts", "cohorts"))
    plain = w.read("mart", "fact_claim_header").drop("condition_group", "condition_sort_order")
    untagged = claims.drop("condition_group", "condition_sort_order")
    lines, headers = tables["carrier_line_by_claim"], tables["carrier_header_by_claim"]
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found, wanted in (
            (cohorts.tag_claims(untagged, counts, colocated=True), cohorts.tag_claims(plain, w.read("mart", "bene_condition_count"))),
            (cohorts.cohort_claims(untagged, members, colocated=True), w.read("mart", "ckd_diabetes_cost")),
        ):
            assert "Exchange" not in plan_of(found)
            assert sorted(map(str, found.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))
            assert found.count() > 0
        orphans = check_orphans({"carrier": (lines, headers)}, "clm_id")
        assert "hashpartitioning" not in plan_of(orphans)  # one row of sums goes to one task
        assert [tuple(row) for row in orphans.collect()] == [("carrier", 0, "OK")]
        lost = check_orphans({"carrier": (lines, headers.where("clm_id <> '301'"))}, "clm_id")
        assert [tuple(row) for row in lost.collect()] == [("carrier", 2, "ORPHANS FOUND")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.sql("DROP DATABASE buckets CASCADE")
