"""Shared folders, checked broadcasts and stable hashes for the operators."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of two or three numbers that may be broadcast: about 32 MB in memory.
BROADCAST_ROWS = 500_000
#: Words of a text, for every operator that counts them: runs of anything but
#: space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``,
    or below the warehouse where that is unset.  It goes when the session's JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    session = f"{root.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"
    path, files = _path(spark, session)
    files.mkdirs(path)
    files.deleteOnExit(path)  # takes note of folders that exist
    return f"{session}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, folder: str) -> bool:
    path, files = _path(spark, folder)
    return files.exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a shared folder and read back: computed once, and safe
    from the loss of an executor."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table, hinted for a broadcast if it has at most ``rows``
    rows; a larger one joins by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def hash32(*parts: Column) -> Column:
    """0 to 2**32 - 1 from the parts' text, NULL as empty; the same in every engine
    that has MD5."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(0))


def unit(*parts: Column) -> Column:
    """A number from 0 up to 1, drawn by a hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` on the batches of a task; behind it, memory that Arrow and the C library
    keep for later goes back to the system, as a worker serves other steps too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on the session hands Python workers at most ``rows`` rows at once: with
    long texts, Spark's default is more than an executor and its workers can spare."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows and about ``size`` bytes."""
    for batch in batches:
        step = max(1, min(rows, batch.num_rows * size // max(batch.nbytes, 1)))
        for first in range(0, batch.num_rows, step):
            yield batch.slice(first, step)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as batches of ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
