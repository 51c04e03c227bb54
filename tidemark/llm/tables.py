"""Reading the given tables and storing intermediate ones."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Stands in for a NULL doc_id inside the operators, so that such rows come first.
NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of stored tables, a list for each operator that is running.
_RUNNING: list[list[str]] = []


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    That cuts the lineage and survives lost executors. The write's shuffle files go at
    once; the table goes when the operator that stored it has its result (``complete``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    if _RUNNING:
        _RUNNING[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def complete(operator):
    """Store the frame that an operator returns, and drop all that it stored on the way."""

    @wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        _RUNNING.append([])
        try:
            out = operator(*args, **kwargs)
            spark, own = out.sparkSession, _RUNNING.pop()
            _RUNNING.append([])
            out = store(out, operator.__name__)
            result = _RUNNING[-1]
        finally:
            _RUNNING.pop()
        if _RUNNING:
            _RUNNING[-1].extend(result)
        for path in own:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        return out

    return run


def doc_key() -> Column:
    """The doc_id, NULL as the smallest."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))


def real_id(name: str) -> Column:
    """The inverse of ``doc_key``."""
    return F.when(F.col(name) != NO_ID, F.col(name))
