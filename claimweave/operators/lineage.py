"""Cutting the plan of a frame that many later steps read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write the rows to a new folder and go on from there: they are computed once, and
    outlive any executor.

    The folder is below ``spark.checkpoint.dir``, which all executors share.  A session that
    names none gets one in its warehouse, which is shared too.  It goes when the
    session's JVM ends.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    session = f"{root.rstrip('/')}/lineage-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(session)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)  # takes note of folders that exist
    folder = f"{session}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
