"""Finished parts of long jobs, kept by name in a shared folder, so that a job that lost its driver goes on from them.

A folder serves one job over one input: names say which part it is, not of what data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a table there was written to its end (its writer left ``_SUCCESS``)."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def part(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` of the folder: read if it is finished, else made and written over what is there."""
    path = f"{folder}/{name}"
    if not is_finished(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
