"""Quality rules: counts of a text, and a likelihood ratio of its n-grams.

N-grams are words and pairs of neighbouring words, each by its 64-bit hash. Two
multinomials over them, one of trusted documents and one of the whole corpus, give each
n-gram the logarithm of their ratio; a document's score is the mean over its n-grams, so
length does not count. Every document at or above the threshold passes.

All of it is column expressions. The counts of the most frequent n-grams reach a scan as
an array of fixed size, the value of a scalar subquery, so that no frequent n-gram is a
shuffle key. ``ratios`` and ``judge`` hold any texts against a stored table of every n-gram.
``judge_corpus`` judges a corpus by itself without such a table: each of the other n-grams
is shuffled once, together with its text's key, is counted where it arrives, and sends back
partial sums of ratios only. Its scans have a row for each word and no function of arrays
with a lambda, which Spark would interpret word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import query
from .tables import store, table

_GAPS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8  # words of a window that repeats
_SLOTS = 1 << 16  # places for frequent n-grams, in judge_corpus four times as many
_IDS = 1 << 20  # trusted ids, some 40 MB, that are broadcast
_ROUNDS = 5  # shares of the hashes that are shuffled one after the other
_LONG = 1 << 20  # bytes of a text that always helps to choose frequent n-grams


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _words(text: Column) -> Column:
    """The words between separators; an empty array without one.

    To split at one character is several times faster than at a pattern, also to put a
    blank in place of line ends. Few texts have other separators.
    """
    rare = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c")) | F.contains(text, F.lit("\r"))
    lines = F.split(F.when(rare, F.regexp_replace(text, "[\\t-\\r]", "\n")).otherwise(text), "\n", -1)
    return F.array_remove(F.split(F.array_join(lines, " "), " ", -1), "")


def _with_hashes(docs: DataFrame) -> DataFrame:
    rows = docs.withColumn("_words", _words(F.col("_text")))
    return rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def _grams(buckets: int | None) -> Column:
    """Hashes of the words and of neighbouring words, or their buckets in two ranges."""
    after = F.slice("_hashes", 2, F.greatest(F.size("_hashes"), F.lit(1)))
    pairs = F.zip_with("_hashes", after, lambda a, b: F.xxhash64(a, b))
    # The last word has no neighbour; its place is cut off.
    pairs = F.slice(pairs, 1, F.greatest(F.size("_hashes") - 1, F.lit(0)))
    if buckets is None:
        return F.concat("_hashes", pairs)
    single = F.transform("_hashes", lambda h: F.pmod(h, F.lit(buckets)))
    return F.concat(single, F.transform(pairs, lambda h: F.pmod(h, F.lit(buckets)) + buckets))


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int | None = None) -> DataFrame:
    """``gram, all, ratio``: occurrences in ``docs``, and log(trusted / corpus), of every n-gram.

    Counts cover all of ``docs``, trusted ones those whose id is in ``trusted``. An n-gram
    gets one trusted occurrence more, and as many of the corpus as belong to one: with 1
    more on both sides the n-grams not seen, which grow with the corpus, would take most of
    the trusted mass. Without trusted documents all ratios are 0. With ``buckets``, n-grams
    of a bucket count as one.
    """
    marks = trusted.select("doc_id").dropna().distinct().withColumn("_good", F.lit(1).cast("bigint"))
    rows = _with_hashes(docs.select("doc_id", _text().alias("_text")).join(marks, "doc_id", "left"))
    # Outer: otherwise the plan makes the arrays once more, to leave out empty ones ahead.
    grams = rows.select("_good", F.explode_outer(_grams(buckets)).alias("gram")).where("gram is not null")
    counts = grams.groupBy("gram").agg(F.count("*").alias("all"), F.sum(F.coalesce("_good", F.lit(0))).alias("good"))
    counts = store(counts, "grams")
    share = counts.agg((F.sum("good") / F.sum("all")).alias("share")).first()["share"] or 0.0
    return counts.select("gram", "all", F.log((F.col("good") + 1) / (F.col("all") * share + 1)).alias("ratio"))


def _frequent(ratio: DataFrame) -> DataFrame:
    """One row with ``frequent``: ``_SLOTS`` places by hash, each with its most frequent n-gram.

    N-grams below one in 16 * ``_SLOTS`` occurrences take no place.
    """
    total = ratio.agg(F.sum("all").alias("total"))
    often = ratio.where(F.col("all") * 16 * _SLOTS > total.scalar()).groupBy(F.pmod("gram", F.lit(_SLOTS)).alias("slot"))
    often = often.agg(F.max(F.struct("all", "gram", "ratio")).alias("x"))
    every = ratio.sparkSession.range(0, _SLOTS, 1, 1).select(F.col("id").alias("slot")).join(often, "slot", "left")
    lists = every.agg(F.array_sort(F.collect_list(F.struct("slot", "x.gram", "x.ratio"))).alias("frequent"))
    return store(lists.select(F.transform("frequent", lambda x: F.struct(x["gram"], x["ratio"])).alias("frequent")), "frequent")


def _key() -> Column:
    """Rows with one id and one text have one key, and one score."""
    return F.xxhash64("doc_id", "_text")


def _sums(rows: DataFrame, ratio: DataFrame, buckets: int | None) -> DataFrame:
    """``_key, _sum``: the sum of the ratios of a text's n-grams, of all ``rows``.

    Rows have doc_id and _text. An n-gram that the corpus lacks adds nothing.
    """
    rows = _with_hashes(rows).select(_key().alias("_key"), _grams(buckets).alias("_grams"))
    # Named once only: then the plan holds the array in place and doesn't copy it into each row.
    rows = rows.withColumn("_frequent", _frequent(ratio).scalar())
    found = F.transform("_grams", lambda g: F.struct(g.alias("gram"), F.get("_frequent", F.pmod(g, F.lit(_SLOTS)).cast("int")).alias("x")))
    value = lambda f: F.when(f["x"]["gram"] == f["gram"], f["x"]["ratio"])
    rows = rows.select("_key", F.transform(found, lambda f: F.struct(f["gram"], value(f).alias("known"))).alias("_found"))
    known = F.aggregate("_found", F.lit(0.0), lambda acc, f: acc + F.coalesce(f["known"], F.lit(0.0)))
    # Each text has a row for its frequent ones, spread by the key; the others wait for the table.
    first = F.array(F.struct(F.col("_key").alias("gram"), known.alias("known")))
    rows = rows.select("_key", F.concat(first, F.filter("_found", lambda f: f["known"].isNull())).alias("_grams"))
    grams = rows.select("_key", F.explode_outer("_grams").alias("g"))
    found = grams.select("_key", "g.*").join(ratio.select("gram", "ratio"), "gram", "left")
    value = F.coalesce("known", "ratio", F.lit(0.0))
    # Rows that repeat share a key, each with the same sum.
    sums = found.groupBy("_key").agg((F.sum(value) / F.count("known")).alias("_sum"))
    return store(sums, "sums")


def _repeat_words() -> Column:
    """Words inside windows that stand in the text twice or more, from sorted ``_places``.

    Windows are sorted by (hash, place); those with an equal neighbour repeat. Their
    places, sorted again, cover a window each, less what the next one covers.
    """
    return F.aggregate(
        F.zip_with(
            "_places",
            F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1))),
            lambda a, b: F.least(F.coalesce(b - a, F.lit(_WINDOW)), F.lit(_WINDOW)),
        ),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x,
    )


def _joined(hashes: str, step: int) -> Column:
    """Hashes of twice as many words as ``hashes`` are of; the last ones reach past the end."""
    after = F.slice(hashes, step + 1, F.greatest(F.size(hashes), F.lit(1)))
    return F.zip_with(hashes, after, lambda a, b: F.xxhash64(a, b))


def counts(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a column ``_text``, with its base counts."""
    rows = docs.withColumn("_words", _words(F.col("_text")))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(_GAPS)) != "")
    rows = rows.withColumn("_lines", lines)
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace("_text", f"[^{_SYMBOLS}]+", "")).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_two": _joined("_words", 1),
        }
    ).drop("_lines", "_words")
    rows = rows.withColumn("_four", _joined("_two", 2)).drop("_two")
    # A window that repeats makes five runs of four words repeat; few texts have them.
    may = F.size("_four") - F.size(F.array_distinct("_four")) >= _WINDOW - 3
    rows = rows.withColumn("_four", F.when(may, F.col("_four")).otherwise(F.array().cast("array<bigint>")))
    windows = F.slice(_joined("_four", 4), 1, F.greatest(F.size("_four") - _WINDOW + 1, F.lit(0)))
    rows = rows.withColumn("_windows", windows).drop("_four")
    rows = rows.withColumn("_windows", F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    repeated = F.filter(
        "_windows", lambda s, i: (F.get("_windows", i - 1)["w"] == s["w"]) | (F.get("_windows", i + 1)["w"] == s["w"])
    )
    rows = rows.withColumn("_places", F.sort_array(F.transform(repeated, lambda s: s["i"]))).drop("_windows")
    return rows.withColumn("n_repeat_words", _repeat_words()).drop("_places")


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``_text`` and ``_key`` of every row; the key's lowest bit tells a trusted row.

    Up to ``_IDS`` trusted ids go to every executor; with more, each scan shuffles the texts.
    """
    marks = trusted.select(F.col("doc_id").cast("bigint")).dropna().distinct()
    marks = store(marks.withColumn("_good", F.lit(1).cast("bigint")), "marks")
    if marks.count() <= _IDS:
        marks = F.broadcast(marks)
    rows = docs.select("doc_id", _text().alias("_text")).join(marks, "doc_id", "left")
    bit = F.coalesce("_good", F.lit(0).cast("bigint"))
    return rows.select("doc_id", "_text", _key().bitwiseAND(F.lit(-2).cast("bigint")).bitwiseOR(bit).alias("_key"))


def _by_word(rows: DataFrame) -> DataFrame:
    """``_key, place, word, pair``: a row for each word with its n-grams, one of NULLs for a text without words.

    The n-grams are those of ``_grams``; the last word has no pair.
    """
    # Outer: otherwise the plan splits the texts once more, to leave out empty ones ahead.
    rows = rows.select("_key", _words(F.col("_text")).alias("_words"))
    rows = rows.select("_key", "_words", F.posexplode_outer("_words").alias("place", "w"))
    rows = rows.select("_key", "place", "w", F.get("_words", F.col("place") + 1).alias("after"))
    word = F.when(F.col("w").isNotNull(), F.xxhash64("w"))
    rows = rows.select("_key", "place", word.alias("word"), F.when(F.col("after").isNotNull(), F.xxhash64("after")).alias("after"))
    return rows.select("_key", "place", "word", F.when(F.col("after").isNotNull(), F.xxhash64("word", "after")).alias("pair"))


def _exploded(rows: DataFrame) -> DataFrame:
    grams = _by_word(rows).unpivot("_key", ["word", "pair"], "kind", "gram")
    return grams.select("_key", "gram").where("gram is not null")


def _good() -> Column:
    return F.col("_key").bitwiseAND(F.lit(1).cast("bigint"))


def _slot(gram: Column) -> Column:
    return F.pmod(gram, F.lit(4 * _SLOTS)).cast("int")


def _places(chosen: DataFrame, value: str) -> DataFrame:
    """One row with an array of ``value`` at each taken place, NULL at the others."""
    every = chosen.sparkSession.range(0, 4 * _SLOTS, 1, 1).select(F.col("id").cast("int").alias("slot"))
    every = every.join(chosen.select("slot", value), "slot", "left")
    lists = every.agg(F.sort_array(F.collect_list(F.struct("slot", value))).alias("places"))
    return store(lists.select(F.col(f"places.{value}").alias("places")), "places")


def _candidates(rows: DataFrame) -> DataFrame:
    """For each place by hash the n-gram that is most frequent in a part of the texts.

    The part is one text in 16, by hash, and every long one. N-grams found once there take no
    place. Which ones are chosen changes no result, only what is shuffled.
    """
    part = rows.where((F.pmod(F.hash("_key"), F.lit(16)) == 0) | (F.octet_length("_text") > _LONG))
    counted = _exploded(part).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    often = counted.groupBy(_slot(F.col("gram")).alias("slot")).agg(F.max(F.struct("n", "gram")).alias("x"))
    return _places(often.select("slot", "x.gram"), "gram")


def _ratio(all_: str, good: str, share: float) -> Column:
    return F.log((F.col(good) + 1) / (F.col(all_) * share + 1))


def corpus_sums(rows: DataFrame, rounds: int = _ROUNDS) -> DataFrame:
    """``_key, _sum``: the sum of the ratios of a text's n-grams, a row for every text of ``rows``.

    ``rows`` come from ``_marked``. Counts cover every row. N-grams without a place are
    shuffled in ``rounds`` by hash, whose files go before the next round starts.
    """
    chosen = _candidates(rows).scalar()
    has_place = lambda gram: F.coalesce(F.get(chosen, _slot(gram)) == gram, F.lit(False))
    gram = F.col("gram")
    grams = _exploded(rows)
    counted = grams.groupBy(F.when(has_place(gram), _slot(gram)).otherwise(-1).alias("slot"))
    counted = store(counted.agg(F.count("*").alias("all"), F.sum(_good()).alias("good")), "frequent")
    share = counted.agg((F.sum("good") / F.sum("all")).alias("share")).first()["share"] or 0.0
    ratio = _places(counted.where("slot >= 0").withColumn("ratio", _ratio("all", "good", share)), "ratio").scalar()
    known = lambda gram: F.when(has_place(gram), F.get(ratio, _slot(gram))).otherwise(0.0)
    texts = _by_word(rows).withColumn("known", known(F.col("word")) + known(F.col("pair")))
    first = F.when(F.coalesce("place", F.lit(0)) == 0, 1).otherwise(0)
    sums = store(texts.groupBy("_key").agg(F.sum("known").alias("s"), F.sum(first).alias("n")), "texts")
    # A gram's texts lie together once sorted; the sums per text are made before they move.
    other = Window.partitionBy("gram")
    for r in range(rounds):
        mine = grams.where((F.pmod(F.shiftright("gram", 40), F.lit(rounds)) == r) & ~has_place(gram))
        mine = mine.withColumns({"all": F.count("*").over(other), "good": F.sum(_good()).over(other)})
        part = mine.groupBy("_key").agg(F.sum(_ratio("all", "good", share)).alias("s"))
        sums = sums.unionByName(store(part.withColumn("n", F.lit(0).cast("bigint")), f"round_{r}"))
    # Rows that repeat share a key, each with the same sum.
    return sums.groupBy("_key").agg((F.sum("s") / F.sum("n")).alias("_sum"))


def _verdict(rows: DataFrame, threshold: float) -> DataFrame:
    """The columns of the result, from the counts and ``_sum``."""
    score = F.when(F.col("n_words") > 0, F.col("_sum") / (2 * F.col("n_words") - 1)).otherwise(0.0)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumns({"score": score, "base_failed": failed})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def judge_corpus(docs: DataFrame, trusted: DataFrame, threshold: float = -0.2, rounds: int = _ROUNDS) -> DataFrame:
    """``judge(docs, ratios(docs, trusted), threshold)`` without a table of all n-grams.

    A NULL text counts as empty; without words the score is 0 and the base rules fail. Long
    texts are counted whole. Rows that repeat are judged each by itself. An empty table gives
    no rows; other columns of ``docs`` are not looked at.
    """
    marked = _marked(docs, trusted)
    sums = corpus_sums(marked, rounds)
    return _verdict(counts(marked).drop("_text").join(sums, "_key", "left"), threshold)


def judge(docs: DataFrame, ratio: DataFrame, threshold: float = -0.2, buckets: int | None = None) -> DataFrame:
    """The counts, the score and the verdict for every row.

    ``ratio`` comes from ``ratios`` with the same ``buckets``. A NULL text counts as empty;
    without words the score is 0 and the base rules fail. Rows that repeat are judged each
    by itself.
    """
    texts = docs.select("doc_id", _text().alias("_text"))
    sums = _sums(texts, ratio, buckets)
    rows = counts(texts).withColumn("_key", _key()).drop("_text").join(sums, "_key", "left")
    return _verdict(rows, threshold)


@query()
def op3_ngram_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents, against the documents of good quality."""
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return judge_corpus(docs, trusted)
