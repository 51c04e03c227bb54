from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark import schemas
from tidemark.operators import lines, scan, series
from tidemark.session import materialize, shared_folder
from tidemark.sources import files


@pytest.fixture(scope="module", autouse=True)
def several_tasks(spark):
    """Keep all tasks of a shuffle, so that a sorted series spans several of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def points(spark):
    data = [
        (("hot", "cold")[i % 3 == 0] if i % 11 else None, i * i % 997 + i * 1000 if i > 2 else None, float(i % 17) if i % 5 else None)
        for i in range(400)
    ]
    return spark.createDataFrame(data, "series string, x bigint, y double").repartition(3).persist()


def test_running_mean_of_sine(spark):
    df = series.sine(spark.createDataFrame([("s", i) for i in (1, 2, 3)], "series string, x bigint"))
    means = [round(r.avg, 6) for r in series.running_mean(df).orderBy("x").collect()]
    assert means == [0.841471, 0.875384, 0.630629]
    assert round(df.first().y, 6) == round(math.sin(1), 6)


def test_split_series_equal_whole_windows(points, rows):
    whole = Window.partitionBy("series").orderBy("x")
    mean = points.withColumn("avg", F.avg("y").over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(series.running_mean(points)) == rows(mean)
    numbered = points.withColumn("n", F.row_number().over(whole).cast("bigint"))
    assert rows(series.ordinals(points)) == rows(numbered)


def test_one_series_spans_tasks(spark):
    wide = spark.range(4000).select(F.lit("s").alias("series"), F.col("id").alias("x"), F.lit(1.0).alias("y"))
    tasks = scan.in_order(wide, ["series", "x"], "parts").select("_task").distinct().count()
    assert tasks > 1
    assert series.running_mean(wide).where("avg = 1").count() == 4000
    assert series.ordinals(wide).where("n = x + 1").count() == 4000


@pytest.mark.parametrize("size", [1, 2, 10, 100])
@pytest.mark.parametrize("piece", [3, 64, 100_000])
def test_rolling_mean_over_pieces(points, rows, size, piece):
    frame = Window.partitionBy("series").orderBy("x").rowsBetween(1 - size, 0)
    want = points.withColumn("avg", F.avg("y").over(frame))
    assert rows(series.rolling_mean(points, size, piece=piece)) == rows(want)


def test_last_points(points, rows):
    last = series.last_points(points, 5)
    assert last.count() == 15
    biggest = points.dropna(subset=["series"]).groupBy("series").agg(F.max("x").alias("x"))
    assert last.join(biggest, ["series", "x"]).count() == 2


def test_ordinal_of_a_whole_table(spark, rows):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") % 3).alias("b"))
    got = scan.with_ordinal(df.repartition(7), ["a"])
    assert rows(got, "a", "n") == sorted(((i, i + 1) for i in range(1000)), key=repr)


def test_replay_starts_at_the_second_row(spark, rows):
    df = spark.createDataFrame([(3,), (1,), (2,)], "v int")
    assert rows(series.replay(df, ["v"])) == [(2, 2), (3, 3)]


def test_sensor_records(spark, rows, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"p":1,"q":2,"r":"t","s":1.5,"t":2.5,"u":3.5}\n{"p":2,"q":2,"r":"t","s":1.5,"t":2.5}\n')
    schema = "p int, q int, r string, s double, t double, u double"
    df = files.read_sensor_json(spark, str(path), spark.createDataFrame([], schema).schema)
    assert tuple(df.columns) == schemas.SENSOR_COLUMNS
    assert rows(series.complete(df), "product_id") == [(1,)]


@pytest.fixture(scope="module")
def text_folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("text")
    n = 0
    for part in range(4):
        count = (10, 0, 500, 33)[part]
        (folder / f"part-{part}.txt").write_text("".join(f"line {n + i + 1}\n" for i in range(count)))
        n += count
    return str(folder), n


@pytest.mark.parametrize(("lo", "hi"), [(1, 5), (9, 12), (300, 520), (540, 600), (1, None), (200, 200)])
def test_line_numbers(spark, rows, text_folder, lo, hi, monkeypatch):
    path, n = text_folder
    # Small splits, so that one file is read by several tasks.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = sorted(tuple(r) for r in lines.numbered_lines(spark, path, lo, hi).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    last = n if hi is None else min(n, hi - 1)
    assert got == [(i, f"line {i}") for i in range(lo, last + 1)]


def test_first_lines(spark, text_folder):
    path, _ = text_folder
    assert sorted(r.n for r in lines.first_lines(spark, path, 12).collect()) == list(range(1, 13))


def test_materialized_tables_are_read_from_the_shared_folder(spark, rows):
    df = spark.range(5).withColumn("v", F.rand())
    stored = materialize(df, "random")
    assert rows(stored) == rows(stored)
    files_read = stored.inputFiles()
    assert files_read
    assert all(shared_folder(spark).removeprefix("file:") in f for f in files_read)
    assert all(spark.sparkContext.applicationId in f for f in files_read)
