"""Every registered query against its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from tidemark import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = Counter(tuple(map(_plain, r)) for r in df.select(*columns).collect())
    answer = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    order = [names.index(c) for c in columns]
    want = Counter(tuple(_plain(r[i]) for i in order) for r in answer.fetchall())
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert got == want
    assert sum(got.values()) > 0


def test_entry_ranks_topics(spark):
    top = entry_points.entry(spark)
    assert top.columns == ["topic", "num_tweets", "num_tweets_rnk"]
    assert [r.num_tweets_rnk for r in top.orderBy("num_tweets_rnk").collect()] == list(range(1, 11))


def test_golden_top_topics(spark):
    top = entry_points.queries()["top_topics"](spark, "/root/testdata/sf0.01").orderBy("num_tweets_rnk")
    assert [(r.topic, r.num_tweets) for r in top.collect()][:8] == [
        ("click", 1738),
        ("error", 1724),
        ("signup", 1713),
        ("view", 1705),
        ("purchase", 1691),
        ("k93", 121),
        ("k9", 117),
        ("k96", 115),
    ]
