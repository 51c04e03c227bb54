"""Bigram corpus and phrase queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bigrams, transitions
from ..plans import phrases
from ..session import materialize, scratch_path
from ..sources import files, testdata
from . import query
from .fixtures import NGRAMS

_FILE_NO = T.StructType([T.StructField("file_no", T.IntegerType())])
# Some hundred documents of a file are a piece when runs are searched; their ids share their ten thousands.
_PIECE = 10_000
MAX_WORDS, SEED = 6, 42


def _landed(spark: SparkSession, sf_dir: str, compression: str = "none") -> DataFrame:
    """The corpus as tab separated files in one folder per file number."""
    path = scratch_path(spark, "corpus")
    # Rows of a folder come from few tasks; a large folder is split over several.
    lines = testdata.ngrams(spark, sf_dir, by_file=True).drop("doc_id", "pos")
    files.write_tsv(lines, path, partition_by=["file_no"], compression=compression)
    return files.read_ngrams(spark, path, _FILE_NO)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.corpus_counts(testdata.ngrams(spark, sf_dir))


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus counts as a stored table, the input of all next-word work."""
    return materialize(transitions.totals(_counts(spark, sf_dir)), "totals")


@query(f"WITH {NGRAMS} SELECT file_no, bi_gram, year, match_count FROM lines")
def ngram_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir).select("file_no", "bi_gram", "year", "match_count")


@query(f"WITH {NGRAMS} SELECT file_no, bi_gram, year, match_count FROM lines")
def ngram_scan_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from gzip files, which Spark inflates as it reads."""
    return _landed(spark, sf_dir, "gzip").select("file_no", "bi_gram", "year", "match_count")


@query(f"WITH {NGRAMS} SELECT file_no, bi_gram, year, match_count FROM lines WHERE file_no BETWEEN 0 AND 32")
def corpus_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files one of three nodes would hold; other folders are not read."""
    part = bigrams.file_slice(_landed(spark, sf_dir), 0, 32)
    return part.select("file_no", "bi_gram", "year", "match_count")


@query(f"WITH {NGRAMS} SELECT gram0, gram1, match_count FROM cleaned")
def clean_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bigrams.clean(testdata.ngrams(spark, sf_dir))


@query(f"WITH {NGRAMS} SELECT gram0, gram1, n AS matchcount FROM totals")
def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


@query(f"""WITH {NGRAMS},
marked AS (
  SELECT *, CASE WHEN lag(bi_gram) OVER w IS NOT DISTINCT FROM bi_gram THEN 0 ELSE 1 END AS fresh
  FROM lines WINDOW w AS (PARTITION BY file_no ORDER BY doc_id, pos)),
numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY file_no ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS run FROM marked)
SELECT file_no, min(doc_id) AS doc_id, arg_min(pos, (doc_id, pos)) AS pos, w1 AS gram0, w2 AS gram1,
       CAST(sum(match_count) AS BIGINT) AS matchcount
FROM numbered WHERE regexp_full_match(w1, '[A-Za-z]+') AND regexp_full_match(w2, '[A-Za-z]+')
GROUP BY file_no, run, w1, w2""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = testdata.ngrams(spark, sf_dir)
    return bigrams.run_totals(lines, ["doc_id", "pos"], block=F.floor(F.col("doc_id") / _PIECE))


@query(f"""WITH {NGRAMS} SELECT file_no % 3 AS shard, gram0, gram1, CAST(sum(match_count) AS BIGINT) AS matchcount
FROM cleaned GROUP BY ALL""")
def transition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts written to three shard folders, read in one scan over the three paths."""
    path = scratch_path(spark, "shards")
    lines = testdata.ngrams(spark, sf_dir).withColumn("shard", F.col("file_no") % 3)
    usable = lines.select("shard", "match_count", *bigrams.split_words()).where(bigrams.usable())
    counts = usable.groupBy("shard", "gram0", "gram1").agg(F.sum("match_count").alias("matchcount"))
    files.write_tsv(counts, path, partition_by=["shard"])
    return files.read_counts(spark, [f"{path}/shard={i}" for i in range(3)], base=path)


@query(f"WITH {NGRAMS} SELECT gram0, gram1, n FROM totals")
def transition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transitions.totals(_counts(spark, sf_dir))


@query(f"WITH {NGRAMS} SELECT gram0, gram1, n, total, n / total AS probability FROM cdf")
def transition_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transitions.probabilities(_totals(spark, sf_dir))


@query(f"WITH {NGRAMS} SELECT gram0, gram1, n, cum_lo, cum_hi, total FROM cdf")
def transition_cdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transitions.cumulative(_totals(spark, sf_dir)).drop("size")


@query(f"WITH {NGRAMS} SELECT gram1, n, n / total AS probability FROM cdf WHERE gram0 = 'the'")
def next_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transitions.successors(_counts(spark, sf_dir), "the")


@query(f"""WITH RECURSIVE {NGRAMS},
seeds AS (SELECT doc_id AS walk_id, regexp_extract(text, '[A-Za-z]+') AS word FROM documents),
walk AS (
  SELECT walk_id, 1 AS step, word, word AS phrase FROM seeds
  UNION ALL
  SELECT w.walk_id, w.step + 1, c.gram1, w.phrase || ' ' || c.gram1
  FROM walk w JOIN cdf c ON c.gram0 = w.word
   AND CAST('0x' || substr(md5('{SEED}|' || w.walk_id || '|' || w.step), 1, 13) AS BIGINT) % c.total >= c.cum_lo
   AND CAST('0x' || substr(md5('{SEED}|' || w.walk_id || '|' || w.step), 1, 13) AS BIGINT) % c.total < c.cum_hi
  WHERE w.step < {MAX_WORDS})
SELECT walk_id, CAST(max(step) AS INTEGER) AS words, arg_max(phrase, step) AS phrase FROM walk GROUP BY walk_id""")
def phrase_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One phrase per document, from its first word."""
    return phrases.phrases(_counts(spark, sf_dir), testdata.seeds(spark, sf_dir), MAX_WORDS, SEED)
