"""Near duplicates by a chosen-path set similarity join.

Documents become sets of word shingles, and each set a row of ``_SIZE`` minwise
tokens. A tree deals the documents to nodes by two tokens of its own; a node with
many documents deals them again, four times over, by four further tokens that a hash of
the node picks, and so on. Small nodes compare all their documents. Trees are
independent: a pair of similarity 0.75 stays together at the root with probability 0.56
and at each further level with 0.78, one of similarity 0.65 and less grows rarer with
each level. Fourteen trees miss one pair of 0.75 in 100,000 at their roots, and three in a
thousand two levels below, in groups of thousands of documents that are nearly as
similar; mostly such a pair is joined by other links too.

Only links that can join two components matter. Groups of near copies are settled first:
among the documents that share one of a few tokens each is compared with eight of them, where
possible of the largest component there. Then the trees compare documents of different
components only, and a node counts as small once few documents are outside its largest
component: no more than the nodes below it might have together. Each level's rows are
stored once they are dealt. Nodes that stay large down to the last level, whose documents agree in most
tokens, compare each document with eight of them as well. Documents with equal
sets take part as one. Comparisons pass filters by set size and by one bit of the least hash
in each of 256 ranges, in the trees' nodes one by parities, then the full sets. Parities
are those of the hashes of a set that fall on each of some two to four bits a shingle. Two
sets differ in at least as many shingles as their parities in bits, so that this filter loses
no link, and few pairs that are no links pass it: those which only a collision of bits hides.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .graph import components
from .rolling import Roller, mix, text_bytes
from .shingles import shingle_sets
from .tables import complete, doc_key, real_id, store, table

_SIZE = 64  # minwise tokens of a set
_RANGES = 256  # ranges of hashes whose least members are compared first, by one bit each
_DEVIATIONS = 4.5  # by which the number of bits that differ may exceed its mean
_HEADS = 8  # documents of a node that all others are compared with to settle groups
_SETTLING = [(1, 2), (3, 4)]  # the last tokens but so many settle groups of near copies, in turn
_PICKS = 4  # times a large node deals its documents again
_DEPTH = 12  # levels after which large nodes are not dealt any further
_LEAST_BITS, _MOST_BITS = 1 << 8, 1 << 16  # parities of a set
_BITS = [f"b{i}" for i in range(_RANGES // 64)]
_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, _SIZE, dtype=np.uint64) | np.uint64(1)


def _range_bits(hashes: np.ndarray, at: np.ndarray, sets: int) -> np.ndarray:
    """For each set a bit of its least hash in every range, 64 ranges a number; 0 in empty ones.

    The hashes of a set are in order, so the first one of a range is its least.
    """
    owner = np.repeat(np.arange(sets), np.diff(at))
    place = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.ones(len(hashes), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    owner, place, bit = owner[first], place[first], hashes[first] & np.uint64(1)
    out = np.zeros((len(_BITS), sets), np.uint64)
    np.bitwise_or.at(out, (place // 64, owner), bit << (place % 64).astype(np.uint64))
    return out


def _parities(hashes: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """For each set whether an odd number of its hashes falls on a bit, 64 bits a number.

    A power of two of bits, twice as many as hashes at least, within bounds. Half of the
    bits are the other ones with their upper half added.
    """
    n = np.diff(at)
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64)
    bits = np.clip(bits, _LEAST_BITS, _MOST_BITS)
    ends = np.cumsum(bits)
    low = (hashes[at[0] : at[-1]] & np.uint64(_MOST_BITS - 1)).astype(np.int64)
    place = np.repeat(ends - bits, n) + (low & np.repeat(bits - 1, n))
    odd = np.packbits((np.bincount(place, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little")
    return pa.ListArray.from_arrays(np.concatenate([[0], ends // 64]).astype(np.int32), odd.view("<i8"))


def _sketches(words: int):
    schema = pa.schema(
        [("d", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())]
        + [(b, pa.int64()) for b in _BITS]
        + [("tokens", pa.list_(pa.int32())), ("parities", pa.list_(pa.int64()))]
    )

    def run(batches):
        roller = Roller(5)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            d = batch.column("d")
            for i, j, hashes, at in shingle_sets(data, offsets, words, roller):
                n = np.diff(at)
                full = n > 0
                heads = at[:-1][full]
                tokens = np.zeros((j - i, _SIZE), np.uint32)
                bits = _range_bits(hashes, at, j - i)
                h1 = h2 = np.zeros(j - i, np.uint64)
                if len(heads):
                    for k, factor in enumerate(_FACTORS):
                        least = mix(np.minimum.reduceat(hashes * factor, heads))
                        tokens[full, k] = least >> np.uint64(32)
                    h1, h2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                    h1[full] = np.add.reduceat(mix(hashes ^ np.uint64(1)), heads)
                    h2[full] = np.add.reduceat(mix(hashes ^ np.uint64(2)), heads)
                flat = pa.ListArray.from_arrays(
                    np.arange(0, (j - i) * _SIZE + 1, _SIZE, dtype=np.int32), tokens.reshape(-1).view(np.int32)
                )
                columns = [d.slice(i, j - i), n, *(x.view(np.int64) for x in (h1, h2, *bits)), flat, _parities(hashes, at)]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema
                )

    return run


def _sets(words: int):
    schema = pa.schema([("d", pa.int64()), ("set", pa.binary())])

    def run(batches):
        roller = Roller(5)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j, hashes, at in shingle_sets(data, offsets, words, roller):
                sets = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("d").slice(i, j - i), pa.array(sets)], schema=schema)

    return run


def _linked(percent: int):
    """Pairs whose full sets are similar enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for r, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good[r] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good)) for c in ("a", "b")], schema=schema
            )

    return run


def _alike(x: str, y: str, percent: int) -> Column:
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differing = [F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in _BITS]
    # Of sets just similar enough, a part of the ranges that both fill have different bits.
    far = F.lit(1 - percent / 100)
    filled = _RANGES * (1 - F.exp(-(n + m) / ((1 + percent / 100) * _RANGES)))
    allowed = far / 2 * filled + _DEVIATIONS * F.sqrt(far / 2 * filled)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (reduce(Column.__add__, differing) <= allowed)


def _few_differ(x: str, y: str, percent: int) -> Column:
    """Whether the parities of two sets of nearly one size allow a link."""
    one, two = F.col(f"{x}.parities"), F.col(f"{y}.parities")

    def halved(p: Column) -> Column:
        half = F.shiftright(F.size(p), 1)
        return F.zip_with(F.slice(p, F.lit(1), half), F.slice(p, half + 1, half), Column.bitwiseXOR)

    # Sets just similar enough have widths that differ by one step at most.
    first = F.when(F.size(one) > F.size(two), halved(one)).otherwise(one)
    second = F.when(F.size(two) > F.size(one), halved(two)).otherwise(two)
    differing = F.aggregate(F.zip_with(first, second, Column.bitwiseXOR), F.lit(0), lambda acc, b: acc + F.bit_count(b))
    return (100 + percent) * differing <= (100 - percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _named(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows with the smallest document linked with theirs, ``c``; one name for each document, joined once."""
    names = components(links).select("d", F.col("root").alias("c"))
    return rows.join(names, "d", "left").withColumn("c", F.coalesce("c", "d"))


def _sized(nodes: DataFrame) -> DataFrame:
    """Rows of nodes with several components, with the largest one ``main`` and the number of rows of ``others``."""
    parts = nodes.groupBy("node", "c").agg(F.count("*").alias("k"))
    heads = parts.groupBy("node").agg(F.max(F.struct("k", "c")).alias("main"), F.sum("k").alias("size"))
    heads = heads.select("node", F.col("main.c").alias("main"), (F.col("size") - F.col("main.k")).alias("others"))
    return nodes.join(heads.where("others > 0"), "node")


def _stars(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of each node's documents with up to ``_HEADS`` others of it, of its largest component where possible."""
    row = F.struct((F.col("c") != F.col("main")).alias("other"), "d", "n", *_BITS, "c")
    heads = nodes.groupBy("node", F.pmod(F.xxhash64("d"), F.lit(_HEADS)).alias("nth")).agg(F.min(row).alias("x"))
    pairs = heads.join(nodes.select("node", row.alias("y")), "node").where((F.col("x.c") != F.col("y.c")) & _alike("x", "y", percent))
    return pairs.select(F.col("x.d").alias("a"), F.col("y.d").alias("b"))


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """The pairs whose full sets are similar enough, each once."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = store(pairs, f"{name}_pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("d")).distinct()
    # How many documents are wanted has no bound, so this is no broadcast at any size.
    sets = docs.join(wanted.hint("merge"), "d", "left_semi").mapInArrow(_sets(words), "d long, set binary")
    sets = store(sets, f"{name}_sets")
    both = (
        pairs.join(sets.select(F.col("d").alias("a"), F.col("set").alias("sa")), "a")
        .join(sets.select(F.col("d").alias("b"), F.col("set").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
    )
    return store(both.mapInArrow(_linked(percent), "a long, b long"), f"{name}_links")


def _child(pick: int) -> Column:
    """A node below: the node and four of the document's tokens, whose places the node picks."""
    places = [1 + F.pmod(F.xxhash64("node", F.lit(pick), F.lit(k)), F.lit(_SIZE)) for k in range(4)]
    return F.xxhash64("node", F.lit(pick), *[F.element_at("tokens", p.cast("int")) for p in places])


@complete
def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 75, trees: int = 14, small: int = 64
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Documents are linked if 100 * common shingles >= percent * all shingles of both;
    component_id is the smallest doc_id reachable, and that document is kept. Needs
    columns doc_id and text and ignores others. A text that is NULL or without words
    has no shingles and no links; its document is kept. Rows with one doc_id are one
    vertex with several texts, and rows without doc_id are one that comes before all
    others; their component_id is NULL. Very long texts are hashed whole; an empty table
    gives an empty one. ``trees`` is at most 30.
    """
    docs = docs.select(doc_key().alias("d"), F.col("text").cast("string").alias("text"))
    sketches = store(
        docs.mapInArrow(_sketches(words), f"d long, n long, h1 long, h2 long, {', '.join(f'{b} long' for b in _BITS)}, tokens array<int>, parities array<long>"), "sketches"
    )
    sets = ["h1", "h2", "n"]
    full = sketches.where("n > 0")
    rows = full.groupBy(*sets).agg(F.min("d").alias("first"))
    copies = full.select("d", *sets).join(rows, sets).where("d != first").select(F.col("d").alias("a"), F.col("first").alias("b"))
    lead = full.groupBy(*sets).agg(F.min(F.struct("d", *_BITS, "tokens", "parities")).alias("x"))
    lead = store(lead.select("x.*", "n"), "distinct_sets")

    # Trees have tokens of their own; groups are settled by single ones.
    token = [F.element_at("tokens", i) for i in range(1, _SIZE + 1)]
    picks = [F.xxhash64(F.lit(t), token[2 * t], token[2 * t + 1]) for t in range(trees)]
    links = None
    for turn, some in enumerate(_SETTLING):
        roots = F.array(*[F.xxhash64(F.lit(-i), token[-i]) for i in some])
        named = lead.select("d", "n", *_BITS, roots.alias("roots"))
        named = named.withColumn("c", F.col("d")) if links is None else store(_named(named, links), f"named_{turn}")
        nodes = named.select(F.explode("roots").alias("node"), "d", "n", *_BITS, "c")
        near = _confirmed(_stars(_sized(nodes), percent), docs, words, percent, f"near_{turn}")
        links = near if links is None else links.union(near)
    named = store(_named(lead.select("d", "n", *_BITS, F.array(*picks).alias("roots")), links), "named")
    nodes = named.select(F.explode("roots").alias("node"), "d", "n", *_BITS, "c")
    # Dealt, a document is compared with up to so many others in each of its nodes below.
    few_others = F.col("others") <= _PICKS * small
    small_nodes, met = [], []
    for depth in range(_DEPTH + 1):
        nodes = store(_sized(nodes), f"nodes_{depth}")
        small_nodes.append(nodes.where(few_others))
        many = nodes.where(~few_others)
        if many.isEmpty():
            break
        if depth == _DEPTH:
            met.append(_stars(many, percent))
        dealt = many.select("node", "d", "n", *_BITS, "c").join(lead.select("d", "tokens"), "d")
        dealt = dealt.select(F.explode(F.array(*map(_child, range(_PICKS)))).alias("node"), "d", "n", *_BITS, "c")
        nodes = store(dealt, f"dealt_{depth}")
    few = reduce(DataFrame.union, small_nodes).join(lead.select("d", "n", *_BITS, "parities"), ["d", "n", *_BITS])
    alike = _alike("x", "y", percent) & _few_differ("x", "y", percent)
    # Documents of the node's largest component meet all others, but not each other.
    pairs = (
        few.where(F.col("c") != F.col("main"))
        .alias("x")
        .join(few.alias("y"), (F.col("x.node") == F.col("y.node")) & (F.col("x.c") != F.col("y.c")) & alike)
        .select(F.col("x.d").alias("a"), F.col("y.d").alias("b"))
    )
    met.append(pairs)
    found = _confirmed(reduce(DataFrame.union, met), docs, words, percent, "tree")
    roots = components(copies.union(links).union(found))
    out = sketches.select("d", "n").join(roots, "d", "left").withColumn("c", F.coalesce("root", "d"))
    return out.select(
        real_id("d").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        real_id("c").alias("component_id"),
        (F.col("d") == F.col("c")).alias("kept"),
    )


@query()
def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under similarity of 5-word shingles of 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))
