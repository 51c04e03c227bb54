"""Stored relations that accumulate mini-batches."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import snapshots

_BATCH = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())])

_MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("number", T.LongType()),
    ]
)


class _Manifest(NamedTuple):
    """What a compaction has settled: the runs in force, and the last merged batch of each query."""

    version: int
    runs: dict[str, tuple[int, int]]  # name: (level, files)
    merged: dict[str, int]  # query_id: batch_id


class TableStore:
    """Named tables below one root folder, which accumulate mini-batches.

    Each mini-batch owns the folder (query_id, batch_id) and replaces it as a whole, so a
    batch that is replayed after a failure changes nothing. :meth:`compact` merges closed
    batches into runs: files sorted by the table's first column, with the range of each file
    beside them. As many runs of one level as ``fan`` become one of the next, so a row is
    rewritten a few times only (with a ``fan`` of 1 all runs become one each time) and the number of files read follows the size of the table,
    not the number of batches. A manifest names what is in force, and a new version of it is
    the one step that swaps old for new.

    ``merges`` may give a function for a table whose rows are partial states (sums, sets): it
    turns rows of several batches into fewer rows of the same columns. ``settled`` may give a
    function that drops what a table merged as a whole need not keep. ``tombstones`` names a
    table of ids; rows of tables with that column are left out by ``read(live=True)`` and go when their
    table is compacted, whichever of the two came first.

    One query writes a batch at a time, and one caller at a time compacts a table.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tables: dict[str, T.StructType],
        format: str = "parquet",
        merges: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
        tombstones: str | None = None,
        settled: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
        fan: int = 8,
    ):
        self.spark, self.root, self.tables, self.format = spark, root.rstrip("/"), tables, format
        self.merges, self.settled = dict(merges or {}), dict(settled or {})
        self.tombstones, self.fan = tombstones, fan
        self._merged: dict[str, dict[str, int]] = {}

    def path(self, name: str) -> str:
        if name not in self.tables:
            raise KeyError(f"unknown table {name!r}")
        return f"{self.root}/{name}"

    def write_batch(self, df: DataFrame, name: str, query_id: str, batch_id: int) -> None:
        """Keep one batch. One that a compaction has merged is final, and its replay is left out."""
        if batch_id > self._last_merged(name, query_id):
            self._write(df.withColumn("batch_id", F.lit(batch_id).cast("bigint")), name, query_id)

    def load(self, df: DataFrame, name: str, query_id: str, batch: Column) -> None:
        """Keep rows of many batches at once, such as a backlog; ``batch`` gives each row's number."""
        last = self._last_merged(name, query_id)
        self._write(df.withColumn("batch_id", batch.cast("bigint")).where(F.col("batch_id") > last), name, query_id)

    def _last_merged(self, name: str, query_id: str) -> int:
        if name not in self._merged:
            self._merged[name] = self._manifest(name).merged
        return self._merged[name].get(query_id, -1)

    def _write(self, df: DataFrame, name: str, query_id: str) -> None:
        columns = self.tables[name].fieldNames()
        (
            df.select(*columns, F.lit(query_id).alias("query_id"), "batch_id")
            .write.format(self.format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*_BATCH.fieldNames())
            .save(f"{self.path(name)}/batches")
        )

    def write_batches(self, frames: Mapping[str, DataFrame], query_id: str, batch_id: int) -> None:
        """Keep one batch of several tables, written side by side."""
        with ThreadPoolExecutor(max(1, len(frames))) as pool:
            writes = [pool.submit(self.write_batch, df, name, query_id, batch_id) for name, df in frames.items()]
        for write in writes:
            write.result()

    def read(self, name: str, with_batch: bool = False, live: bool = False) -> DataFrame:
        """All accumulated rows; an untouched table reads as empty.

        A table with a merge function is merged over its runs and batches here too, and
        has no batch columns. ``live`` leaves out rows whose id has a tombstone.
        """
        manifest = self._manifest(name)
        columns = self.tables[name].fieldNames()
        df = self._runs(name, list(manifest.runs)).unionByName(self._open(name, manifest))
        if live:
            df = self._living(df, name)
        if name in self.merges:
            return self._settle(self.merges[name](df.select(*columns)), name)
        return df if with_batch else df.select(*columns)

    def lookup(self, name: str, low: object, high: object) -> DataFrame:
        """Rows whose key is in [low, high]: of the runs only the files whose range meets it are read."""
        manifest = self._manifest(name)
        key, columns = F.col(self._key(name)), self.tables[name].fieldNames()
        files: list[str] = []
        for run in manifest.runs:
            ranges = self.spark.read.parquet(f"{self.path(name)}/ranges/{run}")
            files += [r.file for r in ranges.where((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high))).collect()]
        df = self._open(name, manifest)
        if files:
            df = df.unionByName(self.spark.read.format(self.format).schema(self._full(name)).load(files))
        found = df.where(key.between(F.lit(low), F.lit(high))).select(*columns)
        return self._settle(self.merges[name](found), name) if name in self.merges else found

    def compact(self, name: str, least: int = 2, current: Mapping[str, int] | None = None) -> bool:
        """Merge closed batches into a run, if there are ``least`` or more; tells whether it did.

        A query's newest batch is never closed, as it may be replayed: the one ``current``
        names for it, or else the newest that brought rows. Folders that an
        earlier compaction has replaced are removed, so a reader has the time from
        one compaction to the next but one.
        """
        before = self._manifest(name)
        batches = self._batches(name)
        newest = {q: (current or {}).get(unquote(q), max(bs, default=0)) for q, bs in batches.items()}
        closed = {q: [b for b in bs if before.merged.get(unquote(q), -1) < b < newest[q]] for q, bs in batches.items()}
        folders = [self._batch(name, q, b) for q, bs in closed.items() for b in bs]
        if len(folders) < least:
            return False
        rows = self._load_batches(name, folders)
        level, old = 0, []
        if self.fan == 1:
            old = list(before.runs)
        else:
            while len(same := [run for run, (at, _) in before.runs.items() if at == level]) >= self.fan - 1:
                old += same
                level += 1
        rows = rows.unionByName(self._runs(name, old))
        rows = self._living(rows, name)
        if name in self.merges:
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in _BATCH.fields]
            rows = self.merges[name](rows.select(*self.tables[name].fieldNames()))
            rows = (self._settle(rows, name) if len(old) == len(before.runs) else rows).select("*", *none)
        run, key = uuid.uuid4().hex, self._key(name)
        path = f"{self.path(name)}/runs/{run}"
        rows.repartitionByRange(key).sortWithinPartitions(key).write.format(self.format).save(path)
        written = self._runs(name, [run])
        ranges = written.groupBy(F.input_file_name().alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
        ranges.coalesce(1).write.parquet(f"{self.path(name)}/ranges/{run}")
        runs = {r: v for r, v in before.runs.items() if r not in old} | {run: (level, len(written.inputFiles()))}
        merged = before.merged | {unquote(q): max(bs) for q, bs in closed.items() if bs}
        self._commit(name, _Manifest(before.version + 1, runs, merged))
        self._merged[name] = merged
        self._clear(name, before, {*runs, *before.runs})
        return True

    def compact_all(self, current: Mapping[str, int] | None = None) -> None:
        """Compact every table, side by side; tombstones first, so that the others meet them merged."""
        if self.tombstones:
            self.compact(self.tombstones, current=current)
        with ThreadPoolExecutor(max(1, len(self.tables))) as pool:
            merged = [pool.submit(self.compact, name, current=current) for name in self.tables if name != self.tombstones]
        for one in merged:
            one.result()

    def files(self, name: str) -> int:
        """How many files a reader of the whole table lists."""
        manifest = self._manifest(name)
        return sum(files for _, files in manifest.runs.values()) + len(self._open(name, manifest).inputFiles())

    def reset(self, name: str) -> None:
        """Empty a table, whatever batches it holds."""
        folder, system = self._folder(self.path(name))
        system.delete(folder, True)
        self._merged.pop(name, None)

    def _key(self, name: str) -> str:
        return self.tables[name].fieldNames()[0]

    def _full(self, name: str) -> T.StructType:
        return T.StructType(self.tables[name].fields + _BATCH.fields)

    def _runs(self, name: str, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self._full(name))
        return self.spark.read.format(self.format).schema(self._full(name)).load([f"{self.path(name)}/runs/{r}" for r in runs])

    def _open(self, name: str, manifest: _Manifest) -> DataFrame:
        """Rows of the batches that no run holds."""
        batches = self._batches(name).items()
        folders = [self._batch(name, q, b) for q, bs in batches for b in bs if b > manifest.merged.get(unquote(q), -1)]
        return self._load_batches(name, folders)

    def _load_batches(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._full(name))
        read = self.spark.read.format(self.format).schema(self._full(name))
        return read.option("basePath", f"{self.path(name)}/batches").load(folders)

    def _batch(self, name: str, query: str, batch_id: int) -> str:
        return f"{self.path(name)}/batches/query_id={query}/batch_id={batch_id}"

    def _settle(self, df: DataFrame, name: str) -> DataFrame:
        return self.settled[name](df) if name in self.settled else df

    def _living(self, df: DataFrame, name: str) -> DataFrame:
        """Rows whose id, if the table has one, is not among the tombstones."""
        if self.tombstones in (None, name) or (key := self._key(self.tombstones)) not in self.tables[name].fieldNames():
            return df
        return df.join(self.read(self.tombstones).select(key).distinct(), key, "left_anti").select(*df.columns)

    def _folder(self, path: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str, prefix: str = "") -> list[str]:
        folder, system = self._folder(path)
        if not system.exists(folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]

    def _batches(self, name: str) -> dict[str, list[int]]:
        """Batches by the query's name as it is in the folder's."""
        path = f"{self.path(name)}/batches"
        queries = self._names(path, "query_id=")
        return {q: sorted(map(int, self._names(f"{path}/query_id={q}", "batch_id="))) for q in queries}

    def _manifest(self, name: str) -> _Manifest:
        """The newest complete manifest: some rows for each level and query, read by the driver."""
        rows = snapshots.newest(self.spark, f"{self.path(name)}/manifest", _MANIFEST).collect()
        runs = {r.name: (r.level, r.number) for r in rows if r.level is not None}
        merged = {r.name: r.number for r in rows if r.level is None}
        return _Manifest(max((r.version for r in rows), default=0), runs, merged)

    def _commit(self, name: str, manifest: _Manifest) -> None:
        rows = [(manifest.version, run, level, files) for run, (level, files) in manifest.runs.items()]
        rows += [(manifest.version, query_id, None, batch_id) for query_id, batch_id in manifest.merged.items()]
        df = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        snapshots.write(df, f"{self.path(name)}/manifest", manifest.version)

    def _clear(self, name: str, before: _Manifest, wanted: set[str]) -> None:
        """Remove batches that the manifest before had merged, and runs that neither it nor the new one names."""
        path = self.path(name)
        old = [f"batches/query_id={q}/batch_id={b}" for q, bs in self._batches(name).items() for b in bs if b <= before.merged.get(unquote(q), -1)]
        for kind in ("runs", "ranges"):
            old += [f"{kind}/{run}" for run in self._names(f"{path}/{kind}") if run not in wanted]
        for part in old:
            folder, system = self._folder(f"{path}/{part}")
            system.delete(folder, True)


class AppendStore:
    """The same relations in any source that can append, such as a database connector.

    ``options`` gives a table's options of the source by its name. A source that can't
    replace a batch keeps every attempt at it; reading takes the last attempt of each.
    """

    def __init__(
        self,
        spark: SparkSession,
        format: str,
        tables: dict[str, T.StructType],
        options: Callable[[str], Mapping[str, str]],
    ):
        self.spark, self.format, self.tables, self.options = spark, format, tables, options

    def write_batch(self, df: DataFrame, name: str, query_id: str, batch_id: int) -> None:
        columns = self.tables[name].fieldNames()
        # A later attempt has a later time; the random part keeps equal times apart.
        attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        batch = df.select(
            *columns,
            F.lit(query_id).alias("query_id"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(attempt).alias("attempt"),
        )
        batch.write.format(self.format).options(**self.options(name)).mode("append").save()

    def read(self, name: str, with_batch: bool = False) -> DataFrame:
        """All rows of the last attempts; the table must exist in the source."""
        batch = ["query_id", "batch_id"]
        rows = self.spark.read.format(self.format).options(**self.options(name)).load()
        last = rows.groupBy(*batch).agg(F.max("attempt").alias("attempt"))
        kept = rows.join(last, [*batch, "attempt"], "left_semi")
        columns = self.tables[name].fieldNames()
        return kept.select(*columns, *batch) if with_batch else kept.select(*columns)
