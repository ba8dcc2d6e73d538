"""Writers for vintage tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def write_vintages(df: DataFrame, path: str, vintage: str = "vintage", cluster_by: tuple[str, ...] = ()) -> None:
    """Replace exactly the vintages present in ``df``; other partitions stay untouched.

    Rows are spread by vintage and the cluster columns (range partitioning samples the data,
    so a hot vintage is cut into several files) and sorted inside each file, which keeps
    min/max statistics narrow for later scans.
    """
    keys = (vintage, *cluster_by)
    (df.repartitionByRange(*keys)
       .sortWithinPartitions(*keys)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(vintage)
       .parquet(path))


def append(df: DataFrame, path: str, vintage: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(vintage) if vintage else writer).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_snapshot(spark, path: str, snapshot) -> DataFrame:
    """Rows of one kept version of a table; the filter prunes partitions."""
    return spark.read.parquet(path).where(f"snapshot_date = DATE'{snapshot}'")


def _system(spark: SparkSession, path: str):
    """Hadoop path and file system of a folder, local or remote."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A table, or None where nothing has been written (or everything has been dropped)."""
    where, system = _system(spark, path)
    if not system.exists(where):
        return None
    files = system.listFiles(where, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return spark.read.parquet(path)
    return None


def drop_vintages(spark: SparkSession, path: str, vintages: Iterable[dt.date], vintage: str = "vintage") -> None:
    """Delete the partitions of these vintages; one that is not there is no error."""
    for v in vintages:
        where, system = _system(spark, f"{path}/{vintage}={v}")
        system.delete(where, True)
