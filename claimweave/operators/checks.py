"""Quality checks.

Every check is a small frame (one row per table or one row in all), built from
aggregates that run where the data is.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.exact import rounded_ratio


def rows() -> Column:
    return F.count(F.lit(1))


def _stack(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _side_by_side(values: Mapping[str, DataFrame]) -> DataFrame:
    """Several one-value frames as one row: stacked, then folded by position."""
    stacked = _stack(
        df.toDF("value").withColumn("part", F.lit(i)) for i, df in enumerate(values.values())
    )
    return stacked.agg(
        *[
            F.max(F.when(F.col("part") == i, F.col("value"))).alias(name)
            for i, name in enumerate(values)
        ]
    )


def _named(df: DataFrame, name: str, label: str = "table_name") -> DataFrame:
    return df.select(F.lit(name).alias(label), "*")


#: Measures that count distinct values, for which a table has to be read.
DISTINCT = ("unique_icd_codes", "unique_ndcs", "years_loaded")


class Seen(NamedTuple):
    """A table and the values of aggregates over it, by their texts, that were taken
    while it was written."""

    table: DataFrame
    values: Mapping[str, object]


def measured(source: DataFrame | Seen, measures: Mapping[str, Column]) -> DataFrame:
    """One row of aggregates.  Of a table that was seen being written only those are
    computed whose values aren't known."""
    df = source.table if isinstance(source, Seen) else source
    whole = df.agg(*[measure.alias(name) for name, measure in measures.items()])
    if not isinstance(source, Seen):
        return whole
    known = {n: source.values[str(m)] for n, m in measures.items() if str(m) in source.values and n not in DISTINCT}
    rest = [measure.alias(name) for name, measure in measures.items() if name not in known]
    row = df.agg(*rest) if rest else df.sparkSession.range(1)
    return row.select(
        *[
            F.lit(known[field.name]).cast(field.dataType).alias(field.name) if field.name in known else field.name
            for field in whole.schema
        ]
    )


Source = DataFrame | Seen


def verdict(ok: Column, good: str = "OK", bad: str = "MISMATCH") -> Column:
    """``good`` where the condition holds, ``bad`` where it does not or is unknown."""
    return F.when(ok, good).otherwise(bad)


def all_zero(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(name) == 0 for name in columns])


def check_row_counts(tables: Mapping[str, Source], expected: Mapping[str, int]) -> DataFrame:
    """Rows of each table against the expected number."""
    return _stack(
        _named(measured(df, {"actual_rows": rows()}), name).withColumn(
            "expected_rows", F.lit(expected.get(name)).cast("bigint")
        )
        for name, df in tables.items()
    ).withColumn("result", verdict(F.col("actual_rows") == F.col("expected_rows")))


def nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def check_nulls(tables: Mapping[str, Source], column: str) -> DataFrame:
    """NULLs in a column that must not have any."""
    return _stack(
        _named(measured(df, {"null_count": nulls(column)}), name)
        for name, df in tables.items()
    ).withColumn("result", verdict(F.col("null_count") == 0, bad="HAS NULLS"))


def check_key_fanout(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows, distinct keys, missing keys and average rows per key."""
    return _stack(
        _named(
            df.agg(
                rows().alias("total_rows"),
                F.count_distinct(key).alias("unique_keys"),
                F.count_if(F.col(key).isNull()).alias("null_keys"),
            ),
            name,
        )
        for name, df in tables.items()
    ).select(
        "*",
        F.round(
            F.col("total_rows").cast("decimal(20,0)")
            / F.nullif(F.col("unique_keys"), F.lit(0)).cast("decimal(20,0)"),
            1,
        ).alias("avg_rows_per_key"),
        verdict(F.col("null_keys") == 0, bad="HAS NULLS").alias("result"),
    )


def check_id_sign(df: DataFrame, name: str, key: str) -> DataFrame:
    """Distinct ids that are negative numbers, which synthetic ids must be.

    The ids are made distinct first, so one pass over distinct ids gives all
    three counts."""
    number = F.col(key).try_cast("bigint")
    return _named(
        df.select(key)
        .distinct()
        .agg(
            F.count(key).alias("total_ids"),
            F.count_if(number < 0).alias("negative_ids"),
            F.count_if(number >= 0).alias("positive_ids"),
        )
        .withColumn("result", verdict(F.col("positive_ids") == 0, bad="HAS POSITIVE IDs")),
        name,
    )


def date_format_of(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return (
        F.when(text.rlike(r"^\d{2}-[A-Za-z]{3}-\d{4}$"), "DD-Mon-YYYY")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "ISO format")
        .otherwise("Unknown format")
    )


def classify_date_format(df: DataFrame, column: str) -> DataFrame:
    """How many values are written in which date format."""
    return df.groupBy(date_format_of(column).alias("date_format_detected")).agg(
        rows().alias("total_rows")
    )


def check_amounts(tables: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Missing and literally zero amounts of a text column."""
    return _stack(
        _named(
            df.agg(
                rows().alias("total_rows"),
                F.count_if(F.col(column).isNull()).alias("null_amounts"),
                F.count_if(F.col(column) == "0").alias("zero_amounts"),
            ),
            name,
        )
        for name, df in tables.items()
    ).withColumn("result", verdict(F.col("null_amounts") == 0, bad="HAS NULLS"))


def check_unique(df: DataFrame, name: str, key: str | Sequence[str]) -> DataFrame:
    """Rows against distinct keys; missing keys count as duplicates."""
    key = [key] if isinstance(key, str) else key
    return _named(
        df.agg(rows().alias("total_rows"), F.count_distinct(*key).alias("unique_keys")), name
    ).select(
        "*",
        (F.col("total_rows") - F.col("unique_keys")).alias("duplicates"),
        verdict(F.col("total_rows") == F.col("unique_keys"), bad="DUPLICATES FOUND").alias(
            "result"
        ),
    )


def check_lengths(df: DataFrame, columns: Sequence[str], code: str, min_length: int) -> DataFrame:
    """Shortest and longest text per column, and codes that lost leading zeros."""
    bounds = [
        bound(F.length(name)).alias(f"{label}_{name}_len")
        for name in columns
        for label, bound in (("min", F.min), ("max", F.max))
    ]
    return df.agg(
        *bounds, F.count_if(F.length(code) < min_length).alias("short_codes")
    ).withColumn("result", verdict(F.col("short_codes") == 0, bad="LEADING ZEROS LOST"))


def check_ref(
    tables: Mapping[str, DataFrame], key: str, reference: DataFrame, bad: str = "UNMATCHED"
) -> DataFrame:
    """Distinct keys of each table that exist in the reference table.

    Both sides are made distinct before the join, so a key that owns many rows
    weighs as much as any other."""
    known = reference.select(key).distinct().withColumn("known", F.lit(True))
    return _stack(
        _named(
            df.where(F.col(key).isNotNull())
            .select(key)
            .distinct()
            .join(known, key, "left")
            .agg(
                rows().alias("total_ids"),
                F.count_if(F.col("known")).alias("matched"),
                F.count_if(F.col("known").isNull()).alias("unmatched"),
            ),
            name,
        )
        for name, df in tables.items()
    ).withColumn("result", verdict(F.col("unmatched") == 0, bad=bad))


class Split(NamedTuple):
    raw: Source
    header: Source
    line: Source


def check_split(
    splits: Mapping[str, Split],
    expected_header: Mapping[str, int | DataFrame],
    expected_line: Mapping[str, int | DataFrame],
) -> DataFrame:
    """Header and line rows against the expected numbers, and the raw rows.  An expected
    number may be a frame of one value, which is then computed with the rest."""

    def counted(name: str, split: Split) -> DataFrame:
        found = {
            "header_rows": measured(split.header, {"value": rows()}),
            "line_rows": measured(split.line, {"value": rows()}),
            "raw_rows": measured(split.raw, {"value": rows()}),
        }
        wanted = {"expected_header": expected_header.get(name), "expected_line": expected_line.get(name)}
        frames = {label: value for label, value in wanted.items() if isinstance(value, DataFrame)}
        literals = {label: value for label, value in wanted.items() if label not in frames}
        return _named(_side_by_side({**found, **frames}), name).select(
            "table_name", *found,
            *[
                (F.lit(literals[label]) if label in literals else F.col(label)).cast("bigint").alias(label)
                for label in wanted
            ],
        )

    return _stack(counted(*item) for item in splits.items()).withColumn(
        "result",
        verdict(
            (F.col("header_rows") == F.col("expected_header"))
            & (F.col("line_rows") == F.col("expected_line"))
        ),
    )


class Total(NamedTuple):
    """An amount to sum up: ``amount`` is a column expression over ``df``."""

    df: DataFrame
    amount: Column


def _difference(left: Total, right: Total, names: tuple[str, str], digits: int | None):
    def total(side: Total) -> DataFrame:
        value = F.sum(side.amount)
        return side.df.agg(value if digits is None else F.round(value, digits))

    return _side_by_side({names[0]: total(left), names[1]: total(right)})


def check_fan_trap(header: Total, first_lines: Total, name: str, tolerance: float = 1) -> DataFrame:
    """Header total against the total over first lines of the raw table: summing
    a header amount over all lines would multiply it."""
    names = ("total_from_header", "total_first_line_only")
    return _named(_difference(header, first_lines, names, None), name).withColumn(
        "result", verdict(F.abs(F.col(names[0]) - F.col(names[1])) < tolerance)
    )


def check_totals(
    pairs: Mapping[str, tuple[Total, Total]], tolerance: float = 0.01
) -> DataFrame:
    """Staging total against raw total, both in whole units."""
    names = ("staging_total", "raw_total")
    return _stack(
        _named(_difference(staging, raw, names, 0), name)
        for name, (staging, raw) in pairs.items()
    ).select(
        "*",
        F.abs(F.col("staging_total") - F.col("raw_total")).alias("diff"),
        verdict(F.abs(F.col("staging_total") - F.col("raw_total")) < tolerance).alias("result"),
    )


def profile(source: Source, name: str, measures: Mapping[str, Column]) -> DataFrame:
    """All measures of one table in a single pass."""
    return _named(measured(source, measures), name)


def observable(measures: Mapping[str, Column]) -> list[Column]:
    """The measures that can be taken while a table is written: all but distinct counts."""
    return [measure for name, measure in measures.items() if name not in DISTINCT]


def out_of_range(column: str, first: str, last: str) -> Column:
    day = F.col(column)
    return (day < F.lit(first).cast("date")) | (day > F.lit(last).cast("date"))


def _claim_measures(wrong_code: Column, first: str, last: str, admission: bool) -> dict[str, Column]:
    code = F.col("prncpal_dgns_cd")
    counts = {
        "null_from_dt": F.col("clm_from_dt").isNull(),
        **({"null_clm_admsn_dt": F.col("clm_admsn_dt").isNull()} if admission else {}),
        "null_pmt": F.col("clm_pmt_amt").isNull(),
        "negative_pmt": F.col("clm_pmt_amt") < 0,
        "wrong_code": wrong_code,
        "out_of_range": out_of_range("clm_from_dt", first, last),
        "bad_icd_length": ~F.length(code).between(3, 7),
        "icd_has_dots": code.contains("."),
    }
    return {
        "total_rows": rows(),
        **{label: F.count_if(condition) for label, condition in counts.items()},
        "unique_icd_codes": F.count_distinct(code),
        "total_pmt_amt": F.round(F.sum("clm_pmt_amt")),
    }


def claim_measures(
    columns: Sequence[str], type_code: str, first: str = "2015-01-01", last: str = "2025-12-31"
) -> dict[str, Column]:
    """What :func:`claim_profile` measures of a header table with these columns."""
    return _claim_measures(F.col("nch_clm_type_cd") != type_code, first, last, "clm_admsn_dt" in columns)


def claim_profile(
    header: Source, name: str, type_code: str, first: str = "2015-01-01", last: str = "2025-12-31"
) -> DataFrame:
    """Dates, amounts, type code, diagnosis code shape and total of a header table;
    missing admission dates too, if the claim type has them."""
    columns = (header.table if isinstance(header, Seen) else header).columns
    return profile(header, name, claim_measures(columns, type_code, first, last))


def claim_profiles(
    headers: DataFrame,
    type_codes: Mapping[str, str],
    first: str = "2015-01-01",
    last: str = "2025-12-31",
) -> DataFrame:
    """:func:`claim_profile` of several claim types that one table holds, told apart by
    ``claim_type_key``, in one pass."""
    wanted = F.create_map(*[F.lit(x) for item in type_codes.items() for x in item])
    wrong = F.col("nch_clm_type_cd") != wanted[F.col("claim_type_key")]
    return (
        headers.where(F.col("claim_type_key").isin(*type_codes))
        .groupBy(F.col("claim_type_key").alias("table_name"))
        .agg(*[m.alias(label) for label, m in _claim_measures(wrong, first, last, True).items()])
    )


def claim_verdicts(profiles: Sequence[DataFrame]) -> DataFrame:
    """Header profiles of several claim types with one verdict each, and the total."""
    measures = ["null_from_dt", "null_pmt", "wrong_code", "out_of_range"]
    return _stack(
        frame.select("table_name", "total_rows", *measures, "total_pmt_amt") for frame in profiles
    ).withColumn("result", verdict(all_zero(measures), bad="CHECK DETAILS"))


def pde_measures(first: str = "2015-01-01", last: str = "2025-12-31") -> dict[str, Column]:
    product = F.col("prod_srvc_id")
    return {
        "total_rows": rows(),
        "null_srvc_dt": nulls("srvc_dt"),
        "null_cost": nulls("tot_rx_cst_amt"),
        "negative_cost": F.count_if(F.col("tot_rx_cst_amt") < 0),
        "out_of_range_dt": F.count_if(out_of_range("srvc_dt", first, last)),
        "bad_ndc_length": F.count_if(F.length(product) != 11),
        "ndc_non_numeric": F.count_if(product.rlike("[^0-9]")),
        "unique_ndcs": F.count_distinct(product),
        "min_date": F.min("srvc_dt"),
        "max_date": F.max("srvc_dt"),
        "total_drug_cost": F.round(F.sum("tot_rx_cst_amt")),
    }


def pde_profile(
    pde: Source, name: str = "pde", first: str = "2015-01-01", last: str = "2025-12-31"
) -> DataFrame:
    """Dates, cost and product code shape of the drug events."""
    return profile(pde, name, pde_measures(first, last))


def person_measures() -> dict[str, Column]:
    born = F.col("bene_birth_dt")
    year = "enrollmt_ref_yr"
    return {
        "total_rows": rows(),
        "null_birth_dt": F.count_if(born.isNull()),
        "suspicious_birth": F.count_if(born < F.lit("1900-01-01").cast("date")),
        "years_loaded": F.count_distinct(year),
        "min_year": F.min(year),
        "max_year": F.max(year),
    }


def person_profile(snapshots: Source, name: str = "beneficiary") -> DataFrame:
    """Birth dates and years of the person snapshots."""
    return profile(snapshots, name, person_measures())


def check_orphans(pairs: Mapping[str, tuple[DataFrame, DataFrame]], key: str) -> DataFrame:
    """Lines whose key has no header, per claim type.

    Lines are counted per key first, so a claim with very many lines joins as
    one row.  Lines without a key are orphans."""

    def orphans(line: DataFrame, header: DataFrame) -> DataFrame:
        per_key = line.groupBy(key).agg(rows().alias("lines"))
        return per_key.join(header.select(key), key, "left_anti").agg(
            F.coalesce(F.sum("lines"), F.lit(0).cast("bigint")).alias("orphans")
        )

    return _stack(
        _named(orphans(line, header), name, "claim_type")
        for name, (line, header) in pairs.items()
    ).withColumn("result", verdict(F.col("orphans") == 0, bad="ORPHANS FOUND"))


def check_coverage(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct codes of a fact, how many of them the dimension knows, in percent."""
    found = check_ref({"fact": fact}, key, dim)
    return found.select(
        F.col("total_ids").alias("codes_in_claims"),
        F.col("matched").alias("matched_in_dim"),
        rounded_ratio(F.col("matched") * 100, F.col("total_ids"), 1).alias("coverage_pct"),
    )


def snapshot_summary(snapshots: DataFrame) -> DataFrame:
    """Rows, persons and missing values per snapshot year."""
    return (
        snapshots.groupBy("enrollmt_ref_yr")
        .agg(
            rows().alias("total_rows"),
            F.count_distinct("bene_id").alias("unique_bene"),
            F.count_if(F.col("bene_birth_dt").isNull()).alias("null_birth_dt"),
            F.count_if(F.col("age_at_end_ref_yr").isNull()).alias("null_age"),
        )
        .orderBy("enrollmt_ref_yr")
    )


def duplicates_skipped(df: DataFrame, key: str) -> DataFrame:
    """What :func:`~claimweave.operators.keys.dedupe_first` leaves out."""
    return df.groupBy(key).agg(rows().alias("copies")).agg(
        F.sum("copies").alias("total_codes"),
        rows().alias("unique_codes"),
        F.sum(F.col("copies") - 1).alias("duplicates_skipped"),
    )
