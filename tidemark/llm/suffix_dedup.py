"""Removal of repeated byte strings by prefix-free parsing.

Rolling hashes of ``gram`` bytes act as triggers: of the grams inside a string of
``length`` bytes the one with the smallest hash is its trigger, so equal strings
have equal triggers wherever they stand. Neighbouring starts with one trigger form a
phrase. A phrase with the bytes its last string still needs is an entry of the
dictionary; the phrases of a document in their order are its parse.

Two strings can only be equal if their phrases have the same trigger. So the order
of the corpus' suffixes, as far as ``length`` bytes reach, is found in two steps:

1. Dictionary: entries are put in order of (trigger, entry, place). Of equal entries
   the first stays, all strings in the others are repeats. A trigger with one entry
   only needs no more work.
2. Where a trigger has several entries, the suffixes of these entries are put in
   order of (string, place) themselves; all but the first of equal strings are repeats.

Entries and strings go by two 64-bit hashes. A batch first settles its own repeats
and sends one row per entry, string or mixed trigger, so a key that holds a third of
all rows still gets one row per batch only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.scan import with_ordinal
from . import query
from .rolling import Roller, sliding_min, text_bytes
from .tables import NO_ID, doc_key, store, table

#: Bytes of text hashed at once; a longer document is cut into overlapping segments.
_CHUNK = 1 << 19
_SEGMENT = 1 << 22

# The place of a phrase within its document, packed: kind, tag, start, strings.
# The tag numbers different texts that share a doc_id.
_OPEN, _REPEAT, _CHECK = 0, 1, 2
_TAG_BITS, _START_BITS, _COUNT_BITS = 22, 32, 7

_ROWS = "k long, e long, d long, p long"
_SCHEMA = pa.schema([(c, pa.int64()) for c in "kedp"])


def _pack(kind: int, tag: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    out = (np.int64(kind) << (_TAG_BITS + _START_BITS + _COUNT_BITS)) | (tag << (_START_BITS + _COUNT_BITS))
    return out | (start << _COUNT_BITS) | count


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = place >> (_TAG_BITS + _START_BITS + _COUNT_BITS)
    return kind, (place >> _COUNT_BITS) & ((1 << _START_BITS) - 1), place & ((1 << _COUNT_BITS) - 1)


def _told_apart(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with columns d and tag, which tell different texts of one doc_id apart.

    Rows of a doc_id with one text have tag 0. Other texts are numbered along their 128-bit
    hashes: those without doc_id by d, as they come before all others, those of one doc_id
    by tag. Only hashes move for that, and the numbers are joined where there are any.
    """
    text = F.col("text").cast("string")
    hashes = [F.xxhash64(F.coalesce(text, F.lit("")), F.lit(i)).alias(f"h{i}") for i in (1, 2)]
    docs = docs.select("doc_id", text.alias("text"), doc_key().alias("d"), *hashes)
    spread = docs.groupBy("d").agg(F.min(F.struct("h1", "h2")).alias("low"), F.max(F.struct("h1", "h2")).alias("high"))
    shared = spread.where("low != high").select("d")
    texts = store(docs.select("d", "h1", "h2").distinct().join(shared, "d", "left_semi"), "shared_ids")
    if texts.isEmpty():
        return docs.select("doc_id", "text", "d", F.lit(0).cast("bigint").alias("tag"))
    nameless = with_ordinal(texts.where(F.col("d") == NO_ID), ["h1", "h2"])
    nameless = nameless.select("d", "h1", "h2", (F.col("d") + F.col("n")).alias("own"), F.lit(0).cast("bigint").alias("tag"))
    nth = F.row_number().over(Window.partitionBy("d").orderBy("h1", "h2")).cast("bigint")
    named = texts.where(F.col("d") != NO_ID).select("d", "h1", "h2", F.col("d").alias("own"), nth.alias("tag"))
    numbers = store(nameless.union(named), "told_apart")
    return docs.join(numbers, ["d", "h1", "h2"], "left").select(
        "doc_id", "text", F.coalesce("own", "d").alias("d"), F.coalesce("tag", F.lit(0)).alias("tag")
    )


def _chunks(offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document numbers, first bytes, end bytes) of pieces to be hashed together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        if offsets[i + 1] - offsets[i] > _SEGMENT:
            for a in range(int(offsets[i]), int(offsets[i + 1]) - length + 1, _SEGMENT):
                end = min(a + _SEGMENT + length - 1, int(offsets[i + 1]))
                yield np.array([i]), np.array([a]), np.array([end])
            i += 1
            continue
        j = i
        while j < n and offsets[j + 1] - offsets[j] <= _SEGMENT and offsets[j + 1] - offsets[i] <= _CHUNK:
            j += 1
        j = max(j, i + 1)
        yield np.arange(i, j), offsets[i:j], offsets[i + 1 : j + 1]
        i = j


def _phrases(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, roller: Roller):
    """Document number, start, strings, trigger and entry hash of every phrase."""
    width = length - gram + 1
    low = np.uint64((1 << 24) - 1)
    found = []
    for docs, first, end in _chunks(offsets, length):
        base = int(first[0])
        part = data[base : int(end[-1])]
        fits = end - first >= length
        if not fits.any():
            continue
        docs, first, end = docs[fits], first[fits] - base, end[fits] - base
        sums = roller.sums(part)
        grams = roller.every(sums, gram)
        # The gram's place in the low bits makes the first of equal grams the smallest.
        trigger = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width) & low
        edge = np.zeros(len(trigger) + 1, np.int32)
        edge[first] += 1
        edge[end - length + 1] -= 1
        inside = np.flatnonzero(np.cumsum(edge[:-1]))
        trigger = trigger[inside].astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        a = inside[cut]
        last = inside[np.concatenate([cut[1:] - 1, [len(inside) - 1]])]
        doc = np.searchsorted(first, a, side="right") - 1
        entry = roller.of(sums, a, last + length) + (last - a).astype(np.uint64)
        found.append((docs[doc], a + base, last - a + 1, grams[trigger[cut]], entry))
    if not found:
        return None
    doc, start, count, key, entry = (np.concatenate(x) for x in zip(*found, strict=True))
    return doc, start - offsets[doc], count, key.view(np.int64), entry.view(np.int64)


def _settle(k, e, d, tag, start, count, mixed: bool) -> Iterator[pa.RecordBatch]:
    """Rows of one batch after its own repeats are settled; the input is in place order.

    With ``mixed``, a key with several entries is sent once as such, and the first of
    each of its entries is already known to need a check.
    """
    order = np.lexsort((e, k))
    k, e, d, tag, start, count = (x[order] for x in (k, e, d, tag, start, count))
    new_k = np.concatenate([[True], k[1:] != k[:-1]])
    new_e = new_k | np.concatenate([[True], e[1:] != e[:-1]])
    kinds = np.where(new_e, _OPEN, _REPEAT)
    if mixed:
        group = np.cumsum(new_k) - 1
        several = np.bincount(group, weights=new_e) > 1
        kinds[new_e & several[group]] = _CHECK
    place = np.empty(len(k), np.int64)
    for kind in (_OPEN, _REPEAT, _CHECK):
        at = kinds == kind
        place[at] = _pack(kind, tag[at], start[at], count[at])
    settled = kinds != _OPEN
    # Settled rows only pass through, so they are dealt by their place.
    key = np.where(settled, place * np.int64(-7046029254386353131) + d, k)
    yield _batch(key, e, d, place)
    if mixed and several.any():
        at = np.flatnonzero(new_k & several[group])
        yield _batch(k[at], e[at] ^ 1, np.full(len(at), NO_ID), np.full(len(at), -1))


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_SCHEMA)


def _in_place_order(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows by doc_id and text, equal ones once."""
    d, tag = batch.column("d").to_numpy(), batch.column("tag").to_numpy()
    order = np.lexsort((tag, d))
    d, tag = d[order], tag[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (tag[1:] != tag[:-1])])
    return batch.take(pa.array(order[new]))


def _entries(length: int, gram: int):
    def run(batches):
        roller = Roller(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = _in_place_order(batch)
            data, offsets = text_bytes(batch.column("text"))
            found = _phrases(data, offsets, length, gram, roller)
            if found is None:
                continue
            doc, start, count, k, e = found
            d, tag = batch.column("d").to_numpy(), batch.column("tag").to_numpy()
            yield from _settle(k, e, d[doc], tag[doc], start, count, mixed=True)

    return run


def _strings(length: int):
    """Hashes of the strings that start in phrases to be checked."""

    def run(batches):
        rollers = Roller(2), Roller(3)
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = _in_place_order(batch)
            data, offsets = text_bytes(batch.column("text"))
            parts = []
            for i, places in enumerate(batch.column("places")):
                kind, start, count = _unpack(np.asarray(places.values))
                start, count = start[kind == _CHECK], count[kind == _CHECK]
                if not len(start):
                    continue
                text = data[offsets[i] : offsets[i + 1]]
                at = np.unique(np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum()))
                for a in range(0, len(text), _SEGMENT):
                    here = at[(at >= a) & (at < a + _SEGMENT)]
                    if len(here):
                        part = text[a : a + _SEGMENT + length]
                        h = [r.of(r.sums(part), here - a, here - a + length).view(np.int64) for r in rollers]
                        parts.append((np.full(len(here), i), here, *h))
            if parts:
                doc, start, k, e = (np.concatenate(x) for x in zip(*parts, strict=True))
                d, tag = batch.column("d").to_numpy(), batch.column("tag").to_numpy()
                yield from _settle(k, e, d[doc], tag[doc], start, np.ones(len(k), np.int64), mixed=False)

    return run


def _cut(length: int):
    """The spans of covered bytes, and the rest of each text."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ("kept", pa.binary()),
        ]
    )

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            spans, kept = [], []
            for i, (entries, strings) in enumerate(zip(batch.column("places"), batch.column("strings"), strict=True)):
                text = data[offsets[i] : offsets[i + 1]]
                lists = [np.asarray(x.values) for x in (entries, strings) if x.is_valid]
                kind, start, count = _unpack(np.concatenate(lists) if lists else np.zeros(0, np.int64))
                start, count = start[kind == _REPEAT], count[kind == _REPEAT]
                if not len(start):
                    spans.append([])
                    kept.append(text.tobytes())
                    continue
                edge = np.zeros(len(text) + 1, np.int32)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + count + length - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append([{"start": a, "stop": b} for a, b in turns.reshape(-1, 2).tolist()])
                kept.append(text[~gone].tobytes())
            arrays = [batch.column("doc_id"), np.diff(offsets), spans, kept]
            yield pa.RecordBatch.from_arrays(
                [a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)],
                schema=schema,
            )

    return run


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 48) -> DataFrame:
    """Cut every byte covered by a ``length``-byte string that also starts earlier.

    Needs columns doc_id and text, ignores others, and returns ``doc_id, n_bytes,
    spans array<struct<start, stop>>, kept binary`` for every row. Earlier means a
    smaller doc_id, or an earlier start in the same text. A NULL text is empty, a NULL
    doc_id comes before all others. Of rows that repeat a doc_id, different texts count
    as documents in a fixed order, up to four million of them; equal texts count as one
    document and get the same result. There may be any number of rows without doc_id, and
    other ids are above -2**62. Texts shorter than ``length`` stay whole, longer ones are
    hashed in segments whatever their size. An empty table gives an empty one.
    """
    if not 0 < gram < length <= 127:
        raise ValueError("gram must be below length, and length at most 127")
    told_apart = _told_apart(docs)
    docs = told_apart.select("d", "tag", "text")

    by_key, by_entry = Window.partitionBy("k"), Window.partitionBy("k", "e").orderBy("d", "p")
    kind = F.shiftright("p", _TAG_BITS + _START_BITS + _COUNT_BITS)
    rest = F.lit((1 << (_TAG_BITS + _START_BITS + _COUNT_BITS)) - 1)
    tag = F.shiftright("p", _START_BITS + _COUNT_BITS).bitwiseAND((1 << _TAG_BITS) - 1).alias("tag")

    def marked(new_kind) -> DataFrame:
        shifted = F.shiftleft(new_kind.cast("bigint"), _TAG_BITS + _START_BITS + _COUNT_BITS)
        return F.col("p").bitwiseAND(rest).bitwiseOR(shifted)

    entries = (
        docs.mapInArrow(_entries(length, gram), _ROWS)
        .repartition("k")
        .withColumn("nth", F.rank().over(by_entry))
        .withColumn("several", F.min("e").over(by_key) != F.max("e").over(by_key))
        .where((F.col("p") != -1) & ((kind != _OPEN) | (F.col("nth") > 1) | F.col("several")))
        .withColumn("kind", F.when(kind != _OPEN, kind).when(F.col("nth") > 1, _REPEAT).otherwise(_CHECK))
        .select("d", marked(F.col("kind")).alias("p"), tag)
    )
    places = store(entries.groupBy("d", "tag").agg(F.collect_list("p").alias("places")), "suffix_entries")

    checked = places.where(F.exists("places", lambda p: F.shiftright(p, _TAG_BITS + _START_BITS + _COUNT_BITS) == _CHECK))
    strings = docs.join(checked, ["d", "tag"]).mapInArrow(_strings(length), _ROWS)
    strings = (
        strings.withColumn("nth", F.rank().over(by_entry))
        .where((kind == _REPEAT) | (F.col("nth") > 1))
        .select("d", marked(F.lit(_REPEAT)).alias("p"), tag)
    )
    strings = store(strings.groupBy("d", "tag").agg(F.collect_list("p").alias("strings")), "suffix_strings")

    flagged = told_apart.join(places, ["d", "tag"], "left").join(strings, ["d", "tag"], "left")
    return flagged.select(F.col("doc_id").cast("bigint"), "text", "places", "strings").mapInArrow(
        _cut(length), "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
    )


@query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 100-byte strings that also start earlier."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
