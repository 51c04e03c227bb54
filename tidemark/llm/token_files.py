"""Token ids of a corpus in grammar-compressed shards.

Documents are sorted by doc_id, tokenized and cut into shards of whole documents. A shard
is a row of a Parquet table: its grammar, the ids and lengths of its documents, and its
place in the order. So the files live wherever Spark writes, and any document's ids can be read
back alone.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import query
from .re_pair import Grammar, compress
from .tables import doc_key, real_id, store, table

#: Pieces in a tokenizing process' table of ids; it keeps the table before the last, too.
_MEMORY = 400_000

# A run of letters that stay as they are under NFC, then ASCII marks but no apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")

_SHARD = "shard long, task int, n_ids long, docs array<long>, lengths array<long>, grammar binary"


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class _Ids(dict):
    """Numbers of pieces of text between blanks; a piece's ids are encoded when it first comes up.

    The tokenizer ends words at blanks and drops these, so the ids of a text are those of
    its pieces in a row. A plain word goes straight to the model, which sees the same
    letters as behind the normalizer; everything else takes the whole tokenizer. What
    ``older`` remembers, the table before this one, is taken from there.
    """

    def __init__(self, path: str, older: _Ids | None = None):
        super().__init__()
        if older is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
        else:
            self.tokenizer = older.tokenizer
            older.older = None
        self.older, self.model, self.letters = older, self.tokenizer.model, _byte_letters()
        self.flat, self.start, self.length = array("I"), array("q"), array("q")

    def ids(self, piece: str) -> array:
        n = self[piece]
        return self.flat[self.start[n] : self.start[n] + self.length[n]]

    def __missing__(self, piece: str) -> int:
        if self.older is not None and piece in self.older:
            ids = self.older.ids(piece)
        elif plain := _PLAIN.fullmatch(piece):
            word, marks = plain[1].lower(), plain[2]
            if marks:
                ids = self.ids(word) + self.ids(marks)
            elif word != piece:
                self[piece] = n = self[word]
                return n
            else:
                letters = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
                ids = [t.id for t in self.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids if piece else []
        self.start.append(len(self.flat))
        self.length.append(len(ids))
        self.flat.extend(ids)
        self[piece] = n = len(self.start) - 1
        return n


_LOADED: dict[str, _Ids] = {}


def _encode(texts: list[str], path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts in a row, each with its end id, and their numbers of ids."""
    known = _LOADED.get(path)
    if known is None or len(known) > _MEMORY:
        known = _LOADED[path] = _Ids(path, known)
    pieces, counts = [], []
    for text in texts:
        found = text.replace("\n", " ").split(" ")
        pieces.extend(map(known.__getitem__, found))
        counts.append(len(found))
    flat, start, length = (np.array(x, np.int64) for x in (known.flat, known.start, known.length))
    pieces, counts = np.array(pieces, np.int64), np.array(counts, np.int64)
    sizes = length[pieces]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(start[pieces] - ends + sizes, sizes) + np.arange(total)]
    before = np.concatenate([[0], ends])
    stops = before[np.cumsum(counts)]
    return np.insert(ids, stops, end), np.diff(stops, prepend=0) + 1


def _slices(texts: pa.Array, most: int = 1 << 22):
    """Ranges of texts of about ``most`` bytes; a longer text is alone."""
    sizes = np.cumsum(np.fromiter((len(t.as_buffer()) for t in texts), np.int64, len(texts)))
    i = 0
    while i < len(sizes):
        done = sizes[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield i, j
        i = j


def _write(path: str, end: int, terminals: int, size: int):
    schema = pa.schema(
        [("shard", pa.int64()), ("task", pa.int32()), ("n_ids", pa.int64()), ("docs", pa.list_(pa.int64()))]
        + [("lengths", pa.list_(pa.int64())), ("grammar", pa.binary())]
    )

    def run(batches):
        task, nth = TaskContext.get().partitionId(), 0
        docs, lengths, ids = [], [], []

        def shard():
            nonlocal nth
            joined = np.concatenate(ids)
            row = [(task << 32) | nth, task, len(joined), np.concatenate(docs), np.concatenate(lengths)]
            row.append(compress(joined, terminals, end))
            nth += 1
            docs.clear(), lengths.clear(), ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            texts = batch.column("text")
            for i, j in _slices(texts):
                found, counts = _encode(texts.slice(i, j - i).to_pylist(), path, end)
                d = batch.column("d").slice(i, j - i).to_numpy()
                # Documents go to the shard in which their last id falls below its size.
                while len(counts):
                    room = size - sum(map(len, ids))
                    n = max(int(np.searchsorted(np.cumsum(counts), room, side="right")), 0 if ids else 1)
                    if n:
                        cut = int(counts[:n].sum())
                        docs.append(d[:n])
                        lengths.append(counts[:n])
                        ids.append(found[:cut])
                        d, counts, found = d[n:], counts[n:], found[cut:]
                    if len(counts):
                        yield shard()
        if ids:
            yield shard()

    return run


def encode(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end: int = 1, size: int = 1 << 20) -> DataFrame:
    """Shards of about ``size`` ids, written to the shared folder and read again.

    ``vocabulary`` is a file of the public tokenizers: it must lie at the same place on
    every machine. Documents come in the order of doc_id, those without one first, rows
    that repeat an id in the order of their texts; a NULL text counts as empty and has the
    end id alone. A document is never cut, so a task needs some 60 bytes an id of the
    longest one.
    """
    path = public_tokenizers.path(vocabulary)
    terminals = _Ids(path).tokenizer.get_vocab_size()
    rows = docs.select(doc_key().alias("d"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("d", F.xxhash64("text")).sortWithinPartitions("d", "text")
    return store(rows.mapInArrow(_write(path, end, terminals, size), _SHARD), "token_shards")


def _read(batches):
    schema = pa.schema([("shard", pa.int64()), ("d", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())])
    for batch in batches:
        for row in range(batch.num_rows):
            d, counts = (batch.column(c)[row].values.to_numpy() for c in ("docs", "lengths"))
            ids = Grammar(batch.column("grammar")[row].as_py()).all().astype("<u4")
            ends = np.cumsum(counts)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
            shard = np.full(len(d), batch.column("shard")[row].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard, d, ends - counts, counts, np.array(crc, np.int64))], schema=schema)


def decode(shards: DataFrame) -> DataFrame:
    """``shard, task, d, at, n, crc``: documents with their place in the shard and the checksum of their ids."""
    return shards.select("shard", "docs", "lengths", "grammar").mapInArrow(_read, "shard long, d long, at long, n long, crc long")


def starts(shards: DataFrame) -> DataFrame:
    """``shard, first``: how many ids stand before each shard, from sums by task first."""
    up_to = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = shards.groupBy("task").agg(F.sum("n_ids").alias("n"))
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before"))
    inside = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = shards.select("shard", "task", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inner"))
    return rows.join(tasks, "task").select("shard", (F.col("before") + F.col("inner")).alias("first"))


@query()
def op7_re_pair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids, written to grammar files and read back."""
    shards = encode(table(spark, sf_dir, "documents"))
    rows = decode(shards).join(starts(shards), "shard")
    return rows.select(
        real_id("d").alias("doc_id"),
        (F.col("first") + F.col("at")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )
