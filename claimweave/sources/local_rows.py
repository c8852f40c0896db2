"""Small literal tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {
    "string": pa.string(),
    "boolean": pa.bool_(),
    "smallint": pa.int16(),
    "int": pa.int32(),
    "bigint": pa.int64(),
}


def literal_table(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """``rows`` as a local relation; ``schema`` reads ``"name type, ..."``.

    Going through Arrow makes it a relation whose exact size the optimizer
    knows, so it decides by itself whether to broadcast it.
    """
    fields = [field.split() for field in schema.split(",")]
    table = pa.table(
        {
            name: pa.array([row[i] for row in rows], _ARROW[kind])
            for i, (name, kind) in enumerate(fields)
        }
    )
    return spark.createDataFrame(table)
