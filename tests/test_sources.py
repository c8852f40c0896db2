import pytest

from claimweave.session import shuffle_partitions
from claimweave.sources import layouts
from claimweave.sources.files import read_code_list, read_text_table, write_table
from claimweave.sources.layouts import CLAIM_LAYOUTS, cols, header_fields, line_fields, names, series


def test_layout_sizes():
    sizes = {name: len(layout) for name, layout in CLAIM_LAYOUTS.items()}
    assert sizes == {
        "inpatient": 197, "outpatient": 162, "carrier": 96, "dme": 87, "snf": 160,
        "hospice": 86, "hha": 88,
    }
    assert (len(layouts.BENEFICIARY), len(layouts.PDE)) == (185, 36)
    headers = {name: len(header_fields(layout)) for name, layout in CLAIM_LAYOUTS.items()}
    assert headers == {
        "inpatient": 193, "outpatient": 127, "carrier": 51, "dme": 49, "snf": 148,
        "hospice": 68, "hha": 68,
    }
    for layout in CLAIM_LAYOUTS.values():
        assert len(set(names(layout))) == len(layout)
        assert header_fields(layout) + line_fields(layout) == layout


def test_series():
    assert names(series("01..12", "m_#"))[0] == "m_01"
    assert series("1..2", "a#", "b#:D") == cols("a1 b1:D a2 b2:D")


def test_text_table(spark, tmp_path, rows_of):
    path = tmp_path / "t.csv"
    path.write_text('A|B|C\n007||"x|""y"""\n" "|""|z\n')
    df = read_text_table(spark, str(path), ["a", "b", "c"])
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert rows_of(df) == [(" ", "", "z"), ("007", None, 'x|"y"')]


def test_text_table_reads_many_files_and_can_check_headers(spark, tmp_path, rows_of):
    for i in (1, 2):
        (tmp_path / f"{i}.csv").write_text(f"A|B\n{i}|x\n")
    paths = [str(tmp_path / f"{i}.csv") for i in (1, 2)]
    assert rows_of(read_text_table(spark, paths, ["a", "b"])) == [("1", "x"), ("2", "x")]
    assert rows_of(read_text_table(spark, paths, ["a", "b"], check_header=True)) == [
        ("1", "x"), ("2", "x"),
    ]
    with pytest.raises(Exception, match="header"):
        read_text_table(spark, paths, ["b", "a"], check_header=True).collect()


def test_rows_of_the_wrong_width_fail(spark, tmp_path):
    for name, line in (("short", "1"), ("long", "1|2|3")):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"A|B\nx|y\n{line}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            read_text_table(spark, str(path), ["a", "b"]).collect()


def test_shuffle_partitions_follow_the_size():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(10_000) == 40_000


def test_line_breaks_inside_quotes(spark, tmp_path, rows_of):
    path = tmp_path / "t.csv"
    path.write_text('A|B\n1|"two\nlines"\n')
    df = read_text_table(spark, str(path), ["a", "b"], multi_line=True)
    assert rows_of(df) == [("1", "two\nlines")]


def test_code_list(spark, tmp_path, rows_of):
    path = tmp_path / "codes.csv"
    path.write_text(
        ",".join(names(layouts.CODE_LIST)) + "\n"
        'E11,"Type 2, ""adult""",False,4,Endocrine,E08-E13,Diabetes,,\n'
        "E119,Plain,True,4,Endocrine,E08-E13,Diabetes,E11,Type 2\n"
    )
    df = read_code_list(spark, str(path))
    assert rows_of(df, "icd_dgns_cd", "description", "is_billable", "parent_code") == [
        ("E11", 'Type 2, "adult"', False, None),
        ("E119", "Plain", True, "E11"),
    ]


@pytest.mark.parametrize(
    "row", ["E12,short row,True", "E12,x,maybe,4,a,b,c,d,e", "E12,x,True,4,a,b,c,d,e,one more"]
)
def test_malformed_code_list_fails(spark, tmp_path, row):
    path = tmp_path / "codes.csv"
    path.write_text(",".join(names(layouts.CODE_LIST)) + f"\nE11,ok,,,,,,,\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_code_list(spark, str(path)).collect()


def test_write_table_replaces(spark, tmp_path):
    write_table(spark.range(5), str(tmp_path), "t")
    write_table(spark.range(3), str(tmp_path), "t")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
