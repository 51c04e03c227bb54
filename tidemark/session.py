"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidemark", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session on one machine may fall back to a temporary folder; on a
    cluster a machine-local path would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never reused by another call."""
    return f"{_scratch_folder(spark)}/{uuid.uuid4().hex}/{name}"


def drop_scratch(spark: SparkSession) -> bool:
    """Remove what this application stored below the shared folder.

    Results read their intermediate tables lazily, so call this only once they
    have been written elsewhere or are no longer needed.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives the planner
    real sizes, so later joins can choose their strategy from them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Write ``df`` once to the shared folder in sorted buckets of ``keys``.

    A join on exactly these keys reads the buckets as they lie: only its other side
    moves. There are as many buckets as the session has shuffle partitions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    title = f"{name}_{uuid.uuid4().hex}"
    # Rows are dealt to the buckets first, so that each bucket is one file.
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(count, *keys)
    dealt.write.bucketBy(count, *keys).sortBy(*keys).option("path", path).saveAsTable(title)
    return spark.table(title)
