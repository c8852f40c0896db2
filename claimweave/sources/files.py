"""Reading the extracts and writing the layers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from claimweave.sources.layouts import CODE_LIST, names


def read_text_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str = "|",
    check_header: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited files with a header line, every column as text.

    The schema is given, so nothing is inferred and leading zeros survive.  An
    unquoted empty field is NULL, a quoted one is an empty string, and a quote
    inside a quoted field is doubled.  Columns are taken by position;
    ``check_header`` makes a file whose header disagrees fail instead.
    ``multi_line`` allows line breaks inside quotes, at the price that one file
    is then read by one task.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    return spark.read.csv(
        [paths] if isinstance(paths, str) else list(paths),
        schema=schema,
        sep=sep,
        header=True,
        quote='"',
        escape='"',
        nullValue="\u0000",
        emptyValue="",
        enforceSchema=not check_header,
        multiLine=multi_line,
        mode="FAILFAST",
    )


def read_code_list(spark: SparkSession, path: str) -> DataFrame:
    """Flattened code hierarchy from comma-separated files with a header.  An empty
    field is NULL; a row with too few or too many fields, or with a flag that isn't
    one, fails the read."""
    schema = StructType(
        [
            StructField(name, BooleanType() if name == "is_billable" else StringType())
            for name in names(CODE_LIST)
        ]
    )
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        quote='"',
        escape='"',
        nullValue="\u0000",
        emptyValue="",
        mode="FAILFAST",
    )


def with_load_date(df: DataFrame) -> DataFrame:
    return df.withColumn("dwh_load_date", F.current_timestamp())


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, folder: str) -> bool:
    path, files = _files(spark, folder)
    return files.exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    path, files = _files(spark, folder)
    files.delete(path, True)


def _rename(spark: SparkSession, folder: str, to: str) -> None:
    path, files = _files(spark, folder)
    if not files.rename(path, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{folder} can't be renamed to {to}")


def _earlier(root: str, name: str) -> str:
    """Where a table lies while it is being replaced; readers skip the underscore."""
    return f"{root}/_{name}.earlier"


def settle(spark: SparkSession, root: str, name: str) -> None:
    """Put the earlier table back if a replacement died between its two renames."""
    if not _exists(spark, f"{root}/{name}") and _exists(spark, _earlier(root, name)):
        _rename(spark, _earlier(root, name), f"{root}/{name}")


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    fmt: str = "parquet",
    measures: Sequence[Column] = (),
    partition_by: str | None = None,
) -> dict[str, object]:
    """Replace the table ``<root>/<name>`` with the rows of ``df``, and return the values of
    ``measures`` by their texts: aggregates over these rows, without DISTINCT, that are taken
    while they are written.

    The rows go to a new folder first.  When that is whole, its row count is compared with
    the rows that were written, and two renames swap the tables; so a load that fails at any
    time leaves the earlier table, or ``settle`` puts it back.  ``df`` may read the table
    that it replaces.
    """
    spark = df.sparkSession
    settle(spark, root, name)
    table, earlier, fresh = f"{root}/{name}", _earlier(root, name), f"{root}/_{name}.{uuid.uuid4().hex}"
    wanted = {f"m{i}": measure for i, measure in enumerate((F.count(F.lit(1)), *measures))}
    seen = Observation(f"written-{uuid.uuid4().hex}")
    # last before the write, in tasks whose results count once however often they are tried
    writer = df.observe(seen, *[measure.alias(label) for label, measure in wanted.items()]).write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        if fmt == "csv":
            writer.option("header", True).option("escape", '"').csv(fresh)
        else:
            writer.format(fmt).save(fresh)
        values = seen.get
        if fmt == "parquet":
            found = spark.read.schema(df.schema).parquet(fresh).count()  # from the footers
            if found != values["m0"]:
                raise OSError(f"{values['m0']} rows of {name} were written, {found} are there")
    except BaseException:
        remove(spark, fresh)
        raise
    if _exists(spark, table):
        remove(spark, earlier)
        _rename(spark, table, earlier)
    _rename(spark, fresh, table)
    remove(spark, earlier)
    return {str(measure): values[label] for label, measure in wanted.items()}


def write_part(df: DataFrame, root: str, name: str, partition_by: str, part: object) -> None:
    """Replace one part of a partitioned table, that of ``part``, by the rows of ``df``, which
    must all be in it; other parts stay as they are.  No rows leave no part."""
    spark = df.sparkSession
    settle(spark, root, name)
    seen = Observation(f"part-{uuid.uuid4().hex}")
    inside = F.expr(f"CASE WHEN `{partition_by}` <=> {part!r} THEN `{partition_by}` ELSE raise_error('a row of another part') END")
    checked = df.withColumn(partition_by, inside).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = checked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(f"{root}/{name}")
    if not seen.get["rows"]:
        remove(spark, f"{root}/{name}/{partition_by}={part}")


def write_bucketed(df: DataFrame, table: str, folder: str, key: str, buckets: int) -> DataFrame:
    """Replace the catalogue's ``table`` by the rows of ``df`` in so many buckets by ``key``,
    sorted by it.  Tables with the same buckets join and group by the key without a shuffle.

    A bucket is one task's work and can't be split, so the key must not have values that
    own a large share of the rows; ``lookup`` serves keys that may."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", folder).saveAsTable(table)
    return df.sparkSession.table(table)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    settle(spark, root, name)
    return spark.read.parquet(f"{root}/{name}")
