"""Secrets by pattern and by a battery of randomness tests.

Three patterns give the base spans. The battery looks at unbroken runs of encoding
characters: the narrowest encoding that holds a run is inferred (hex, base 32, base 36,
base 62, base 64), and three tests ask whether its characters are a uniform, independent
draw from that alphabet: chi-squared on the counts, runs above and below the middle,
and serial correlation. The smallest of the three probabilities, times three, is the
run's. Within each band of lengths a step-up control of false discoveries tells which
runs are not random; what is left is reported. Bands stand apart because short runs give
weak tests: they would otherwise borrow rejections from the long ones.

All of it is column expressions. Texts are read once; the bands' thresholds come from
counts over a fixed number of bins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import query
from .tables import complete, store, table

# The patterns of the base spans, in the order of their kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "random")

#: Runs below this length are left to the patterns; the tests can't tell them from text.
RUN_LENGTH = 24
_RUN = "[A-Za-z0-9+/_=-]{%d,}" % RUN_LENGTH

# Encodings from narrow to wide: characters, and the alphabet that gives them their places.
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_ENCODINGS = (
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", _LOWER.upper() + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[0-9A-Z]+$", _DIGITS + _LOWER.upper()),
    ("^[0-9A-Za-z]+$", _DIGITS + _LOWER.upper() + _LOWER),
    ("^[0-9A-Za-z_-]+$", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
    ("", _LOWER.upper() + _LOWER + _DIGITS + "+/"),
)
_BANDS = (32, 40, 48, 64, 96, 128, 256, 1024)  # upper ends; the last band has none
_STEPS, _BINS = 20, 6000  # bins a decade of probability, and bins in all


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value found once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """(start, kind, end) of a pattern's matches, in code points, end exclusive.

    The pieces between matches and the matches themselves add up to the places. With
    ``group``, matches whose group is shorter than ``least`` are dropped.
    """
    whole, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    # Zipped first: a lambda that named the arrays would find them anew for each match.
    rows = F.transform(
        F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), groups.alias("part")),
        lambda x: F.struct(
            F.length(x["piece"]).cast("bigint").alias("gap"),
            F.length(x["whole"]).cast("bigint").alias("size"),
            F.coalesce(F.length(x["part"]) >= least, F.lit(False)).alias("good"),
        ),
    )
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def step(acc, row):
        start = acc["at"] + row["gap"]
        end = start + F.coalesce(row["size"], F.lit(0).cast("bigint"))
        here = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        found = F.when(row["good"], F.concat(acc["found"], here)).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    zero = F.lit(0).cast("bigint")
    first = F.struct(zero.alias("at"), nothing.alias("found"))

    def blocks(r):
        # A fold copies its list at each match, so it runs over the root of their number only.
        size = F.ceil(F.sqrt(F.size(r))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(r), size), lambda i: F.aggregate(F.slice(r, i, size), first, step))

    def moved(of_blocks):
        def next_(acc, x):
            return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))

        none = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(of_blocks, none, next_, lambda acc: acc["starts"])

        def shift(x, by):
            one = lambda s: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end"))
            return F.transform(x["found"], one)

        return F.flatten(F.zip_with(of_blocks, starts, shift))

    spans = _once(_once(rows, blocks), moved)
    return F.when(text.rlike(pattern), spans).otherwise(nothing)


def _written(spans: Column) -> Column:
    """``kind:start:end`` of spans, in the order of start and kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def _tail(z: Column) -> Column:
    """Probability of a standard normal value above ``z``, to 1e-7."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def battery(runs: DataFrame) -> DataFrame:
    """Runs of a column ``token`` with the probability ``p`` of their tests and their ``band``."""
    token = F.regexp_replace("token", "=+$", "")
    alphabet = reduce(
        lambda rest, e: F.when(token.rlike(e[0]), F.lit(e[1])).otherwise(rest), reversed(_ENCODINGS[:-1]), F.lit(_ENCODINGS[-1][1])
    )
    runs = runs.withColumn("_chars", F.split(token, "")).withColumn("_alphabet", alphabet)
    runs = runs.withColumn("_chars", F.filter("_chars", lambda c: c != ""))
    runs = runs.withColumn("_x", F.transform("_chars", lambda c: F.instr(F.col("_alphabet"), c).cast("double")))
    n, k = F.size("_x").cast("double"), F.length("_alphabet").cast("double")

    def total(column: Column) -> Column:
        return F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x)

    squares = F.transform(F.array_distinct("_x"), lambda s: F.pow(F.size(F.filter("_x", lambda x: x == s)), F.lit(2)))
    runs = runs.withColumn("_n", n).withColumn("_k", k)
    n, k = F.col("_n"), F.col("_k")
    chi = total(squares) * k / n - n
    f = k - 1
    z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / f) - (1 - 2 / (9 * f))) / F.sqrt(2 / (9 * f))
    # Runs of values above and below the middle of the alphabet.
    runs = runs.withColumn("_up", F.transform("_x", lambda x: F.when(x > F.col("_k") / 2, 1.0).otherwise(0.0)))
    ups = total(F.col("_up"))
    pairs = F.zip_with(F.slice("_up", 2, F.size("_up")), F.col("_up"), lambda a, b: F.abs(F.coalesce(a, b) - b))
    change = 1 + total(pairs)
    runs = runs.withColumn("_ups", ups)
    ups = F.col("_ups")
    mean = 2 * ups * (n - ups) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(var > 0, (F.abs(change - mean) - 0.5) / F.sqrt(var)).otherwise(F.lit(20.0))
    # Correlation of neighbours.
    runs = runs.withColumn("_mean", total(F.col("_x")) / n)
    runs = runs.withColumn("_off", F.transform("_x", lambda x: x - F.col("_mean")))
    spread = total(F.transform("_off", lambda x: x * x))
    joint = total(F.zip_with(F.slice("_off", 2, F.size("_off")), F.col("_off"), lambda a, b: F.coalesce(a * b, F.lit(0.0))))
    z_serial = F.when(spread > 0, F.abs(joint / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(20.0))
    least = F.least(_tail(z_chi), 2 * _tail(F.greatest(z_runs, F.lit(0.0))), 2 * _tail(z_serial))
    runs = runs.withColumn("p", F.least(3 * least, F.lit(1.0)))
    band = reduce(lambda rest, e: F.when(n <= e[1], F.lit(e[0])).otherwise(rest), reversed(list(enumerate(_BANDS))), F.lit(len(_BANDS)))
    return runs.withColumn("band", band).drop(*[c for c in runs.columns if c.startswith("_")])


def _limits(runs: DataFrame, rate: float) -> DataFrame:
    """For each band the last bin of probabilities that the step-up control rejects."""
    bins = runs.groupBy("band", "bin").agg(F.count("*").alias("n"))
    of_band = Window.partitionBy("band")
    bins = bins.withColumn("smaller", F.sum("n").over(of_band.orderBy(F.desc("bin"))))
    bins = bins.withColumn("all", F.sum("n").over(of_band))
    # The upper end of a bin stands for its runs, which keeps the rate from above.
    low = F.pow(F.lit(10.0), -F.col("bin") / _STEPS) <= rate * F.col("smaller") / F.col("all")
    return bins.where(low).groupBy("band").agg(F.min("bin").alias("last"))


@complete
def scan(docs: DataFrame, rate: float = 0.01) -> DataFrame:
    """``doc_id, spans, base`` for every row: arrays of (start, kind, end).

    ``base`` has the pattern matches, ``spans`` the random runs too; kind is a place in
    ``KINDS``. Runs need a letter and a digit, and none may overlap a base span. A text
    that is NULL or empty has no spans. Rows that repeat are scanned each by itself.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text")).select(
        "doc_id",
        "row",
        F.concat(
            _spans(F.col("text"), ASSIGN, 0, 2, ASSIGN_LENGTH), _spans(F.col("text"), ACCESS, 1), _spans(F.col("text"), HEX, 2)
        ).alias("base"),
        F.transform(
            _spans(F.col("text"), _RUN, 3),
            lambda s: F.struct(s.alias("span"), F.substr(F.col("text"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")).alias("token")),
        ).alias("runs"),
    )
    mixed = lambda r: r["token"].rlike("[0-9]") & r["token"].rlike("[A-Za-z]")
    rows = store(rows.withColumn("runs", F.filter("runs", mixed)), "spans")
    runs = rows.select("row", "base", F.explode("runs").alias("r")).select("row", "base", "r.span", "r.token")
    apart = lambda b: (b["end"] <= F.col("span.start")) | (b["start"] >= F.col("span.end"))
    runs = battery(runs.where(F.forall("base", apart)).drop("base"))
    bin_ = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) * _STEPS), F.lit(_BINS)).cast("int")
    runs = store(runs.select("row", "span", "band", bin_.alias("bin")), "runs")
    random = runs.join(_limits(runs, rate), "band", "left").where("last is null or bin < last")
    random = random.groupBy("row").agg(F.collect_list("span").alias("random"))
    rows = rows.drop("runs").join(random, "row", "left")
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.select("doc_id", F.concat("base", F.coalesce("random", nothing)).alias("spans"), "base")


@query()
def op10_randomness_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all documents."""
    rows = scan(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return rows.select(
        "doc_id",
        *map(count, range(3)),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )
