from __future__ import annotations

import random

import duckdb
import numpy as np

from tidemark.llm import ORACLES
from tidemark.llm.url_filter import _passes, bloom, judge, op5_bloom_url_rules

from .conftest import SMALL


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [
        (len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, verdict, rule = max(fits, default=(0, "allow", None))
    return host, path, rule, verdict


def test_cases(spark):
    rules = [("com", "/", "allow"), ("a.com", "/x", "block"), ("A.com".lower(), "/x", "allow"), ("net", "", "block")]
    rules += [("b.net", "/long/er", "allow"), ("", "/empty", "block")]
    urls = [None, "", "no scheme", "http://", "HTTP://A.COM/x?y://z", "x://a.com", "x://ba.com/xy#a/b", "s://q.a.com/xx/y"]
    urls += ["u://b.net/long/er/1", "u://b.net?/long/er", "u://é.NET/É", "u:///empty", "u://a..com/x", "u://com/", "://net"]
    urls += ["u://" + "w." * 300 + "net/" + "p" * 50_000, "u://a.com:80/x"] * 2
    pages = spark.createDataFrame(
        [(i, u, "x", 1) for i, u in enumerate(urls)] + [(None, urls[4], "y", 2)], "page_id long, url string, rule string, _x int"
    )
    got = judge(pages, spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string"))
    want = sorted(((i, *brute(u, rules)) for i, u in [*enumerate(urls), (None, urls[4])]), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {(r.rule, r.verdict) for r in judge(pages, none).collect()} == {(None, "allow")}
    assert judge(pages.limit(0), none).count() == 0


def test_filter_passes_all_listed_and_few_others(spark):
    keys = spark.range(20_000).selectExpr("concat('k', id) as key")
    made = bloom(keys)
    hashes = lambda a, b: np.array(
        [r[0] for r in spark.range(a, b).selectExpr("xxhash64(concat('k', id))").collect()], np.int64
    )
    assert _passes(made, hashes(0, 20_000)).all()
    assert _passes(made, hashes(20_000, 60_000)).mean() < 0.02
    # A filter at its largest size still passes all that is listed.
    assert _passes(bloom(keys, most=16), hashes(0, 20_000)).all()


def test_many_rules(spark):
    draw = random.Random(1)
    names = ["a", "b", "c", "com", "net"]
    host = lambda: ".".join(draw.choices(names, k=draw.randrange(1, 4)))
    path = lambda: "/" + "/".join(draw.choices("xyz", k=draw.randrange(4)))
    rules = list({(h, p): (h, p, draw.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(300))}.values())
    urls = [(i, f"http://{host()}{path()}") for i in range(500)]
    got = judge(
        spark.createDataFrame(urls, "page_id long, url string"),
        spark.createDataFrame(rules, "host string, path string, verdict string"),
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, *brute(u, rules)) for i, u in urls)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    got = op5_bloom_url_rules(spark, SMALL)
    want = con.execute(ORACLES["op5_bloom_url_rules"]).fetchall()
    assert sorted(map(tuple, got.select("page_id", "host", "path", "rule", "verdict").collect())) == sorted(want)


def test_hosts_of_many_labels(spark):
    urls = ["u://" + "w." * 100_000 + end for end in ("com/en/x", "example.com/en/", "www.example.com/en/", "org/")]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert sorted(tuple(r) for r in got) == [(i, *brute(u, rules)) for i, u in enumerate(urls)]
