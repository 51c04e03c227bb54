"""Small results that change: a new folder for each version, and the newest complete one to read.

A reader that polls never meets a folder that is being replaced. The last versions but one are
dropped once a newer one is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KEPT = 2


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions, oldest first."""
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    found = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return sorted(v for v in found if system.exists(_folder(spark, f"{path}/version={v}/_SUCCESS")[0]))


def write(df: DataFrame, path: str, version: int) -> None:
    """Write one version; one that is written again replaces itself."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    for old in _versions(spark, path)[:-_KEPT]:
        folder, system = _folder(spark, f"{path}/version={old}")
        system.delete(folder, True)


def newest(spark: SparkSession, path: str, schema: T.StructType, below: int | None = None) -> DataFrame:
    """The newest complete version (below a number); empty where there is none."""
    versions = [v for v in _versions(spark, path) if below is None or v < below]
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1]}")
