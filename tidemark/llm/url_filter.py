"""URL rules behind a blocked Bloom filter.

A URL is cut into every (host or parent domain, start of the path) that a listed rule
could equal. A blocked Bloom filter of the listed ones, eight bits in one 256-bit block
each, lets possible hits pass; an exact hash join with the list removes what passed by
chance, and the longest rule wins. The filter has a fixed largest size: a longer list
fills it more, which costs joins, never results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .tables import complete, store, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Odd factors that pick one bit in each of a block's eight words.
_FACTORS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
#: Blocks of 32 bytes at most: 32 MiB to every executor.
_MOST_BLOCKS = 1 << 20

# The rules that the query judges by.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both are empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(F.coalesce(rest, F.lit("")), F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _bits(low: Column) -> list[Column]:
    """The bit of each word that a hash's low half picks, as a number below 2**32."""
    return [F.shiftrightunsigned((low * F.lit(f)).bitwiseAND(0xFFFFFFFF), 27) for f in _FACTORS]


def bloom(keys: DataFrame, most: int = _MOST_BLOCKS) -> np.ndarray:
    """The filter of a column ``key``: one row of eight 32-bit words for each block.

    Bits are put together by block on the executors; the driver gets the finished blocks.
    """
    n = keys.count()
    blocks = int(min(max(n * 16 // 256, 1), most))
    h = F.xxhash64("key")
    # 31 bits keep the products below 2**63.
    low, high = h.bitwiseAND(0x7FFFFFFF), F.shiftrightunsigned(h, 32)
    rows = keys.select(F.pmod(high, F.lit(blocks)).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(low))])
    words = [F.bit_or(F.expr(f"shiftleft(1L, cast(b{i} as int))")).alias(f"w{i}") for i in range(8)]
    found = rows.groupBy("block").agg(*words).toArrow()
    out = np.zeros((blocks, 8), np.uint64)
    if found.num_rows:
        out[found.column("block").to_numpy()] = np.column_stack([found.column(f"w{i}").to_numpy() for i in range(8)])
    return out.astype(np.uint32)


def _passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64)
    low, block = h & np.uint64(0x7FFFFFFF), (h >> np.uint64(32)) % np.uint64(len(filter_))
    out = np.ones(len(h), bool)
    for i, f in enumerate(_FACTORS):
        bit = ((low * np.uint64(f)) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
        out &= (filter_[block.astype(np.int64), i].astype(np.uint64) >> bit) & np.uint64(1) == 1
    return out


def _possible(held):
    @F.arrow_udf("array<boolean>")
    def test(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            hit = pa.array(_passes(held.value, flat))
            ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hit)

    return test


@complete
def judge(pages: DataFrame, rules: DataFrame, url: str = "url", id_column: str = "page_id") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the
    path starts with the rule's; the longest wins, and of equal ones a block. Without a
    fitting rule the rule is NULL and the verdict allow. Rules with a NULL fit nothing.
    Rows that repeat are judged each by itself, an empty list allows everything. Of a long
    host only as many labels are looked at as the longest host of a rule has.
    """
    spark = pages.sparkSession
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna()
    listed = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.max("verdict").alias("verdict"))
    listed = store(listed.withColumn("size", F.length("key")), "rules")
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    held = spark.sparkContext.broadcast(bloom(listed))

    host, path = parts(F.col(url).cast("string"))
    rows = pages.select(F.col(id_column), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("_row"))
    # Only so many labels as a rule's host has can equal one.
    most = rules.agg(F.max(F.size(F.split("host", "\\.", -1)))).first()[0] or 1
    rows = rows.withColumn("_labels", F.split("host", "\\.", -1))
    rows = rows.withColumn("_labels", F.slice("_labels", F.greatest(F.size("_labels") - most + 1, F.lit(1)), most))
    rows = rows.withColumn(
        "_hosts",
        F.transform("_labels", lambda _, i: F.array_join(F.slice("_labels", i + 1, F.size("_labels")), ".")),
    )
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    rows = rows.withColumn("_starts", F.transform(fitting, lambda n: F.substr("path", F.lit(1), n)))
    keys = F.flatten(F.transform("_hosts", lambda h: F.transform("_starts", lambda p: F.concat(h, p))))
    rows = rows.withColumn("_keys", F.array_distinct(keys)).drop("_labels", "_hosts", "_starts")
    rows = rows.withColumn("_hit", _possible(held)(F.transform("_keys", lambda k: F.xxhash64(k))))
    hits = F.filter(F.arrays_zip("_keys", "_hit"), lambda x: x["_hit"])
    rows = store(rows.select(id_column, "host", "path", "_row", F.transform(hits, lambda x: x["_keys"]).alias("_keys")), "urls")

    exact = rows.select("_row", F.explode("_keys").alias("key")).join(listed, "key")
    # "block" sorts behind "allow".
    best = exact.groupBy("_row").agg(F.max(F.struct("size", "verdict", "key")).alias("x"))
    rows = rows.join(best, "_row", "left")
    return rows.select(
        id_column, "host", "path", F.col("x.key").alias("rule"), F.coalesce("x.verdict", F.lit("allow")).alias("verdict")
    )


_SQL = """
WITH rules(rule_host, rule_path, said) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
urls AS (
    SELECT row_number() OVER () AS nth, page_id,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
split AS (
    SELECT nth, page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM urls),
fits AS (
    SELECT nth, page_id, host, path, rule_host || rule_path AS rule, said,
           row_number() OVER (PARTITION BY nth ORDER BY length(rule_host || rule_path) DESC, said DESC) AS place
    FROM split LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM fits WHERE place = 1
"""


@query(_SQL)
def op5_bloom_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)
