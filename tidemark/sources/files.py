"""Batch readers and writers with fixed schemas."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

# Plain fields between tabs: no quoting, no escapes, blanks kept, every word kept as it is.
_TSV = {
    "sep": "\t",
    "quote": "",
    "escape": "",
    "nullValue": "\u0000",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of social messages; broken lines become all-NULL rows."""
    return spark.read.schema(schemas.MESSAGE).json(path)


def schema_of_line(spark: SparkSession, line: str) -> T.StructType:
    """The schema of one sample JSON line: a help for writing schemas, not used on data."""
    kind = spark.range(1).select(F.schema_of_json(F.lit(line))).first()[0]
    return T.StructType.fromDDL(kind.removeprefix("STRUCT<").removesuffix(">"))


def read_metric_csv(spark: SparkSession, path: str) -> DataFrame:
    """Head-less metric rows from one CSV file, a folder or a glob."""
    return spark.read.schema(schemas.METRIC_CSV).csv(path)


def write_metric_csv(metrics: DataFrame, path: str, mode: str = "append") -> None:
    """Head-less metric rows, added to what is there or replacing it."""
    metrics.select("g", "k", "t", "v").write.mode(mode).csv(path)


def read_ngrams(spark: SparkSession, path: str | list[str], partitions: T.StructType | None = None) -> DataFrame:
    """Tab separated bigram rows without header; quotes are plain characters.

    ``partitions`` names folder columns such as ``file_no``, so that filters
    on them skip whole folders.
    """
    schema = schemas.NGRAM if partitions is None else T.StructType(schemas.NGRAM.fields + partitions.fields)
    return spark.read.schema(schema).options(**_TSV).csv(path)


def write_tsv(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists", compression: str = "none"
) -> None:
    df.write.mode(mode).options(**_TSV, compression=compression).partitionBy(*partition_by).csv(path)


def read_counts(spark: SparkSession, paths: str | list[str], base: str | None = None) -> DataFrame:
    """Bigram counts from any number of locations in one scan.

    With ``base``, the folder level ``shard=<n>`` below it becomes a column.
    """
    if base is None:
        return spark.read.schema(schemas.BIGRAM_COUNT).options(**_TSV).csv(paths)
    schema = T.StructType([*schemas.BIGRAM_COUNT.fields, T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).options(**_TSV, basePath=base).csv(paths)


def file_number(path: Column) -> Column:
    """The number at the end of a file name, as in ``corpus-2gram-17.csv``."""
    return F.regexp_extract(path, r"([0-9]+)(-count)?\.[A-Za-z.]+\z", 1).try_cast("int")


def read_sensor_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Sensor records, their six fields renamed by position."""
    return spark.read.schema(schema).json(path).toDF(*schemas.SENSOR_COLUMNS)


_ZIP_LINES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
_ZIP_BLOCK = 1 << 22


def _whole_lines(raw: IO[bytes]) -> Iterator[bytes]:
    """Blocks of a file that each end with a line; a last line without an end gets one."""
    rest = b""
    while block := raw.read(_ZIP_BLOCK):
        block = rest + block
        cut = block.rfind(b"\n") + 1
        rest = block[cut:]
        if cut:
            yield block[:cut]
    if rest:
        yield rest + b"\n"


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = _ZIP_LINES.fieldNames()
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            archive = zipfile.ZipFile(io.BytesIO(content.as_buffer()))
            for member in archive.namelist():
                with archive.open(member) as raw:
                    start = 1
                    for block in _whole_lines(raw):
                        lines = block[:-1].decode("utf-8").split("\n")
                        yield _line_batch(names, path, member, start, lines)
                        start += len(lines)


def _line_batch(names: list[str], path: str, member: str, start: int, lines: list[str]) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * n), pa.array([member] * n), pa.array(range(start, start + n), pa.int64()), pa.array(lines)],
        names=names,
    )


def read_zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines of all members of zip archives, one archive per task.

    Archives cannot be split; a task inflates its archive in batches and never
    holds the inflated text. Land the corpus as gzip or parquet where possible.
    """
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    return archives.mapInArrow(_unzip, _ZIP_LINES)


def read_zip_ngrams(spark: SparkSession, path: str) -> DataFrame:
    """Bigram rows of zipped TSV files, with ``file_no`` and ``line_no``."""
    cells = F.split("value", "\t")
    fields = [
        F.try_element_at(cells, F.lit(i + 1)).try_cast(field.dataType).alias(field.name)
        for i, field in enumerate(schemas.NGRAM.fields)
    ]
    return read_zip_lines(spark, path).select(file_number(F.col("path")).alias("file_no"), "line_no", *fields)
