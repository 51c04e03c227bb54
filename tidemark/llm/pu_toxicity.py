"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all sampled texts, their labels hidden, are
the unlabelled ones. The share of toxic texts corrects the risk: positives hidden among
the unlabelled count as negatives, so their expected part is taken off again, and where
that would make the negative risk less than zero, the step goes back.

A text is the set of its words, hashed to buckets. The words that differ most between
the two sides are the features of a logistic model. Fitting sees a bounded sample of
labelled rows; scoring reads every text whole, on the executors, with one weight a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .rolling import Roller, text_bytes
from .tables import table

_BITS = 18
_CHUNK = 1 << 19

# Bytes of words: ASCII letters and digits, and all bytes of other characters.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _word_buckets(data: np.ndarray, offsets: np.ndarray, roller: Roller):
    """For ranges of documents: (first, last, document numbers, buckets), a word each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _CHUNK, side="right")) - 1)
        part = data[offsets[i] : offsets[j]]
        edges = offsets[i : j + 1] - offsets[i]
        word = _WORD[part]
        before = np.concatenate([[False], word[:-1]])
        after = np.concatenate([word[1:], [False]])
        inner = edges[(edges > 0) & (edges < len(part))]
        before[inner] = False
        after[inner - 1] = False
        start, stop = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        hashes = roller.of(roller.sums(_LOWER[part]), start, stop)
        doc = np.searchsorted(edges, start, side="right") - 1
        yield i, j, doc, (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
        i = j


def _features(batches):
    """The distinct buckets of every text, with its label."""
    schema = pa.schema([("toxic", pa.int32()), ("buckets", pa.list_(pa.int32()))])
    roller = Roller(7)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for i, j, doc, bucket in _word_buckets(data, offsets, roller):
            keys = np.unique((doc << _BITS) | bucket)
            at = np.searchsorted(keys >> _BITS, np.arange(j - i + 1))
            lists = pa.ListArray.from_arrays(at.astype(np.int32), (keys & ((1 << _BITS) - 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(i, j - i), lists], schema=schema)


def fit(toxic: np.ndarray, at: np.ndarray, buckets: np.ndarray, prior: float, features: int = 2000, steps: int = 400):
    """A weight for each bucket and a bias, from texts given as slices ``at`` of ``buckets``.

    ``toxic`` marks the positives; all rows serve as the unlabelled ones. Without
    positives every text gets the prior as its score.
    """
    weights = np.zeros(1 << _BITS)
    n, n_pos = len(toxic), int(toxic.sum())
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    if not n_pos or n_pos == n:
        return weights, float(np.log(prior / (1 - prior)))
    row = np.repeat(np.arange(n), np.diff(at))
    every = np.bincount(buckets, minlength=1 << _BITS)
    in_pos = np.bincount(buckets[toxic[row]], minlength=1 << _BITS)
    share = every / n
    gap = (in_pos / n_pos - share) / np.sqrt(share * (1 - share) / n_pos + 1e-9)
    gap[every < 5] = 0
    best = np.argsort(-np.abs(gap), kind="stable")[:features]
    best = best[np.abs(gap[best]) > 4]
    column = np.full(1 << _BITS, -1)
    column[best] = np.arange(len(best))
    col = column[buckets]
    row, col = row[col >= 0], col[col >= 0]
    theta, first, second = np.zeros(len(best) + 1), 0.0, 0.0
    theta[-1] = np.log(prior / (1 - prior))
    pos = toxic.astype(float) / n_pos
    for step in range(1, steps + 1):
        margin = np.bincount(row, weights=theta[col], minlength=n) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        as_negative = np.logaddexp(0, margin)
        negative_risk = as_negative.mean() - prior * (pos @ as_negative)
        of_negative = p / n - prior * pos * p
        slope = -prior * pos * (1 - p) + of_negative if negative_risk >= 0 else -of_negative
        grad = np.append(np.bincount(col, weights=slope[row], minlength=len(best)), slope.sum())
        grad[:-1] += 2e-4 * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    weights[best] = theta[:-1]
    return weights, float(theta[-1])


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000):
    """Weights and bias from at most ``sample`` labelled rows, taken by a hash of their id.

    ``labels`` has doc_id and toxic; rows with a NULL in either are left out, and an id
    that is given twice is toxic if one of its rows is.
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = labels.agg(F.avg("toxic")).first()[0] or 0.0
    # At most ``sample`` rows of two numbers, so the size of the broadcast is fixed.
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    found = rows.mapInArrow(_features, "toxic int, buckets array<int>").toArrow().combine_chunks()
    lists = found.column("buckets").combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32()))
    at = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(int)
    toxic = found.column("toxic").to_numpy() == 1
    return fit(toxic, at, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), float(prior))


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """The rows of ``docs`` with a last column ``toxicity``, from their whole texts.

    Without a word, as with a NULL text, a row gets the score of the bias alone.
    """
    held = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))

    @F.arrow_udf("double")
    def rate(texts: pa.Array) -> pa.Array:
        weights, bias = held.value
        data, offsets = text_bytes(texts)
        out = np.full(len(texts), bias)
        for i, j, doc, bucket in _word_buckets(data, offsets, Roller(7)):
            live = weights[bucket] != 0
            keys = np.unique((doc[live] << _BITS) | bucket[live])
            out[i:j] += np.bincount(keys >> _BITS, weights=weights[keys & ((1 << _BITS) - 1)], minlength=j - i)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return docs.withColumn("toxicity", rate(F.col("text").cast("string")))


def held_out():
    """Whether a document is in the fold that is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


@query()
def op2_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of four folds in five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = score(docs, *model).select("doc_id", F.col("toxicity").alias("score"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
