"""Near duplicates of embeddings by a flat proximity graph.

Equal vectors count as one node. Nodes are dealt to shards of bounded size by k-means, level by
level; a node that lies between two cells goes to both, and one of them is its home. Each
shard builds a robust-pruned graph, and the neighbour lists of a node's copies are united.
Every node then searches its shards from their medoids, widens the search to all that lies in
range, and follows what it meets to the shards where that is at home, until no shard is
new. A link counts where the other node is at home, once its cosine in double precision is high
enough. Shards hand on counts and spanning trees in place of pairs.

A fixed number of nodes is then compared with all nodes. If the graph has found too small a
part of their links, everything is built again with more overlap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .flat_graph import STARTS, Search, build, medoids, split_centres, to_centres
from .graph import components
from .tables import complete, real_id, store, table
from .tables import NO_ID

_DEGREE, _BEAM = 24, 32
_SLACK = 0.05  # nodes this far below the least cosine are still expanded
_FAN = 64  # cells that a shard is split into at most
_SAMPLE = 32  # rows a cell that the centres are fitted on
_BLOCK, _ROWS = 512, 8192  # queries searched, rows dealt to cells, at a time
#: (copies, margin): cells a node may go to at each level, if it lies this close to the border.
_OVERLAPS = [(2, 0.05), (3, 0.15), (6, 0.35)]
_FOUND = "kind long, a long, b long, w long"
_NODE = "c long, first long, m long, vec array<double>, shard long, home boolean"


def _units(column) -> np.ndarray:
    """A column of equally long vectors as rows of length one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    points = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    points = points / np.abs(points).max(1, keepdims=True)
    return points / np.sqrt((points * points).sum(1, keepdims=True))


def _usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)


def _child(shard: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """A number for a cell of a shard."""
    h = (shard.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (cell.astype(np.uint64) + np.uint64(1))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _fit(key, rows):
    shard = key[0].as_py()
    centres = split_centres(_units(rows.column("vec")), rows.column("cells")[0].as_py(), shard)
    return pa.table({"shard": [shard], "centres": pa.array([centres.reshape(-1).tolist()], pa.list_(pa.float64()))})


def _deal(copies: int, margin: float):
    def run(key, rows, fitted):
        if not rows.num_rows:
            return rows.drop_columns(["block"])
        points = _units(rows.column("vec"))
        centres = fitted.column("centres")[0].values.to_numpy(zero_copy_only=False).reshape(-1, points.shape[1])
        far = to_centres(points, centres)
        order = np.argsort(far, 1, kind="stable")[:, :copies]
        far = np.take_along_axis(far, order, 1)
        # How far a point is from the plane halfway between its cell's centre and another one.
        apart = np.sqrt(((centres[order] - centres[order[:, :1]]) ** 2).sum(2))
        near = far - far[:, :1] <= 2 * margin * apart
        near[:, 0] = True
        row, nth = np.nonzero(near)
        dealt = rows.drop_columns(["block", "shard", "home"]).take(pa.array(row))
        home = rows.column("home").to_numpy()[row] & (nth == 0)
        shard = _child(np.full(len(row), key[0].as_py(), np.int64), order[row, nth])
        return dealt.append_column("shard", pa.array(shard)).append_column("home", pa.array(home))

    return run


def _blocks(size: Column, rows: int) -> Column:
    return F.ceil(size / rows).cast("int")


def _dealt(nodes: DataFrame, limit: int, copies: int, margin: float) -> DataFrame:
    """Nodes in shards of at most ``limit``; one that lies near a border is in several.

    Centres are fitted on a sample of a few dozen rows a cell; every row is dealt.
    """
    done, level = None, 0
    rows = nodes.withColumn("shard", F.size("vec").cast("long")).withColumn("home", F.lit(True))
    while True:
        sizes = store(rows.groupBy("shard").agg(F.count("*").alias("size"), F.count_distinct("c").alias("nodes")), f"sizes_{level}")
        small = rows.join(sizes.where(F.col("size") <= limit).select("shard"), "shard", "left_semi").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        large = sizes.where(F.col("size") > limit)
        if large.isEmpty():
            return done
        cells = F.least(F.lit(_FAN), 2 + F.ceil(2 * copies * F.col("size") / limit)).cast("int")
        large = large.select("shard", "size", cells.alias("cells"))
        rows = rows.join(large, "shard")
        draw = F.pmod(F.xxhash64("c", "shard"), F.lit(1 << 30)) / (1 << 30)
        sample = rows.where(draw * F.col("size") < _SAMPLE * F.col("cells")).select("shard", "vec", "cells")
        fitted = sample.groupBy("shard").applyInArrow(_fit, "shard long, centres array<double>")
        blocks = _blocks(F.col("size"), _ROWS)
        fitted = large.join(fitted, "shard").select("shard", "centres", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("c"), blocks).cast("int")).select(*nodes.columns, "shard", "home", "block")
        rows = rows.groupBy("shard", "block").cogroup(fitted.groupBy("shard", "block")).applyInArrow(_deal(copies, margin), _NODE)
        rows = store(rows, f"dealt_{level}")
        level += 1


def _graph(rows):
    points = _units(rows.column("vec"))
    c, homes = rows.column("c").to_numpy(), rows.column("home_shard").to_numpy()
    near = build(points, _DEGREE, _BEAM, int(rows.column("shard")[0].as_py()))
    source, nth = np.nonzero(near >= 0)
    target = near[source, nth]
    angle = np.arccos(np.clip(np.einsum("ij,ij->i", points[source], points[target]), -1, 1))
    return pa.table({"c": c[source], "near": c[target], "near_home": homes[target], "angle": angle})


def _trees(linked: np.ndarray, query_ids: np.ndarray, node_ids: np.ndarray) -> list[np.ndarray]:
    """(a, b) pairs that join all vertices which the links join; b is the smallest one found."""
    top = np.iinfo(np.int64).max
    queries, nodes = query_ids.copy(), node_ids.copy()
    while True:
        least = np.minimum(queries, np.where(linked, nodes, top).min(1, initial=top))
        lower = np.minimum(nodes, np.where(linked, least[:, None], top).min(0, initial=top))
        if (least == queries).all() and (lower == nodes).all():
            break
        queries, nodes = least, lower
    pairs = np.concatenate([np.column_stack([query_ids, queries]), np.column_stack([node_ids, nodes])])
    return list(np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0).T)


def _search(cosine: float):
    reach = float(np.arccos(cosine))

    def run(key, nodes, visits):
        if not visits.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in ("kind", "a", "b", "w")})
        shard = key[0].as_py()
        points, queries = _units(nodes.column("vec")), _units(visits.column("vec"))
        c, q = nodes.column("c").to_numpy(), visits.column("c").to_numpy()
        home = nodes.column("home_shard").to_numpy()
        # United lists name nodes by their id; those outside of this shard are followed below.
        number = np.argsort(c)
        owner = np.repeat(np.arange(len(c)), nodes.column("near").combine_chunks().value_lengths().to_numpy())
        near = nodes.column("near").combine_chunks().flatten()
        near_c, near_home, angle = (x.to_numpy() for x in near.flatten())
        at = np.minimum(np.searchsorted(c, near_c, sorter=number), len(c) - 1)
        inside = c[number[at]] == near_c
        count = np.bincount(owner[inside], minlength=len(c))
        neighbours = np.full((len(c), max(1, int(count.max(initial=0)))), -1)
        neighbours[owner[inside], np.arange(inside.sum()) - np.repeat(np.cumsum(count) - count, count)] = number[at[inside]]
        search = Search(points, neighbours, queries)
        search.start(medoids(points, STARTS, shard))
        entry = visits.column("entry").to_pandas().to_numpy(np.float64, na_value=np.nan)
        given = np.flatnonzero(~np.isnan(entry))
        if len(given):
            wanted = visits.column("entry").take(pa.array(given)).to_numpy()
            at = np.minimum(np.searchsorted(c, wanted, sorter=number), len(c) - 1)
            known = c[number[at]] == wanted
            search.visit(given[known], number[at[known]])
        search.descend(_BEAM)
        search.widen(cosine - _SLACK)
        linked = search.similarity >= cosine
        linked &= c[None, :] != q[:, None]
        here = home == shard
        counts = (linked[:, here] * nodes.column("m").to_numpy()[here]).sum(1)
        some = counts > 0
        kinds, a, b, w = [np.zeros(some.sum(), int)], [q[some]], [np.zeros(some.sum(), int)], [counts[some]]
        low, high = _trees(linked, visits.column("first").to_numpy(), nodes.column("first").to_numpy())
        kinds, a, b, w = [*kinds, np.ones(len(low), int)], [*a, low], [*b, high], [*w, np.zeros(len(low), int)]
        # Guests are counted at home. An edge that leaves the shard is followed if its end may be in range.
        guest = np.nonzero(linked & ~here[None, :])
        onward = [(q[guest[0]], home[guest[1]], c[guest[1]])]
        border = np.unique(owner[~inside])
        for i in range(0, len(border), _BLOCK):
            node = border[i : i + _BLOCK]
            row, nth = np.nonzero(search.similarity[:, node] >= cosine - _SLACK)
            node = node[nth]
            own = np.arccos(np.clip(search.similarity[row, node], -1, 1))
            for edge in range(int(np.bincount(owner[~inside]).max(initial=0))):
                out, first = np.flatnonzero(~inside), np.searchsorted(owner[~inside], node) + edge
                real = first < len(out)
                real[real] = owner[out[first[real]]] == node[real]
                leave = out[first[real]]
                close = angle[leave] <= own[real] + reach
                onward.append((q[row[real][close]], near_home[leave[close]], near_c[leave[close]]))
        who, where, entry_of = (np.concatenate(x) for x in zip(*onward, strict=True))
        new = where != shard
        order = np.lexsort((entry_of[new], where[new], who[new]))
        who, where, entry_of = who[new][order], where[new][order], entry_of[new][order]
        first = np.ones(len(who), bool)
        first[1:] = (who[1:] != who[:-1]) | (where[1:] != where[:-1])
        kinds.append(np.full(first.sum(), 2))
        parts = [np.concatenate([*x, y[first]]) for x, y in ((a, who), (b, where), (w, entry_of))]
        return pa.table({"kind": np.concatenate(kinds), **dict(zip("abw", (p.astype(np.int64) for p in parts), strict=True))})

    return run


def _links(nodes: DataFrame, cosine: float, limit: int, copies: int, margin: float) -> DataFrame:
    """Rows (kind, a, b, w): a's links to nodes at home in one shard (0), edges (1), visits asked for (2)."""
    members = _dealt(nodes, limit, copies, margin)
    homes = members.where("home").select("c", F.col("shard").alias("home_shard"))
    members = store(members.drop("home").join(homes, "c"), "members")
    edges = members.groupBy("shard").applyInArrow(_graph, "c long, near long, near_home long, angle double")
    lists = edges.groupBy("c").agg(F.collect_set(F.struct("near", "near_home", "angle")).alias("near"))
    shards = members.join(lists, "c", "left").withColumn("near", F.coalesce("near", F.expr("array()")))
    shards = store(shards, "graph")
    visits = members.select("c", "first", "vec", "shard", F.lit(None).cast("long").alias("entry"))
    found, visited, turn = None, None, 0
    while True:
        seen = visits.select("c", "shard")
        visited = seen if visited is None else visited.union(seen)
        blocks = visits.groupBy("shard").agg(_blocks(F.count("*"), _BLOCK).alias("blocks"))
        block = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
        dealt = visits.join(blocks, "shard").withColumn("block", block).drop("blocks")
        graph = shards.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        both = graph.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block"))
        rows = store(both.applyInArrow(_search(cosine), _FOUND), f"found_{turn}")
        found = rows if found is None else found.union(rows)
        asked = rows.where("kind = 2").groupBy(F.col("a").alias("c"), F.col("b").alias("shard")).agg(F.min("w").alias("entry"))
        asked = store(asked.join(visited, ["c", "shard"], "left_anti"), f"asked_{turn}")
        if asked.isEmpty():
            return found
        visits = store(asked.join(nodes, "c").select("c", "first", "vec", "shard", "entry"), f"visits_{turn}")
        turn += 1


def _true_links(sample: list, cosine: float):
    """Each sampled node's links to the rows of a batch, by comparing it with all of them."""
    ids = np.array([r.c for r in sample], np.int64)
    points = [np.array(r.vec) for r in sample]
    schema = pa.schema([("c", pa.int64()), ("links", pa.int64())])

    def run(batches):
        for batch in batches:
            sizes = batch.column("vec").value_lengths().to_numpy()
            links = np.zeros(len(ids), np.int64)
            for size in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == size))
                some = np.flatnonzero([len(p) == size for p in points])
                if not len(some):
                    continue
                own = _units(pa.array([points[i].tolist() for i in some], pa.list_(pa.float64())))
                hit = own @ _units(rows.column("vec")).T >= cosine
                hit &= ids[some][:, None] != rows.column("c").to_numpy()[None, :]
                links[some] += (hit * rows.column("m").to_numpy()[None, :]).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], schema=schema)

    return run


def _recall(nodes: DataFrame, counts: DataFrame, cosine: float, audit: int) -> float:
    """Part of the links of ``audit`` nodes, picked by hash, that was found."""
    sample = nodes.orderBy(F.xxhash64("c"), "c").limit(audit).select("c", "vec").collect()
    true = nodes.select("c", "m", "vec").mapInArrow(_true_links(sample, cosine), "c long, links long")
    true = true.groupBy("c").agg(F.sum("links").alias("links"))
    both = true.join(counts, "c", "left").agg(F.sum("links").alias("links"), F.sum(F.least("links", F.coalesce("n", F.lit(0)))).alias("n"))
    links, n = both.first()
    return n / links if links else 1.0


@complete
def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, limit: int = 1024, audit: int = 500, target: float = 0.97
) -> DataFrame:
    """``vec_id, n_links, component_id, kept, recall`` for every row.

    Two vectors are linked if they have equally many components and their cosine, in double
    precision, is at least ``cosine``; n_links counts the links that were found to other rows,
    equal vectors included. component_id is the smallest vec_id reachable by links. ``recall``
    is the part of the links of ``audit`` nodes that the graph found, the same in all rows;
    below ``target`` the search is done again with more overlap, twice at most.

    Needs columns vec_id and embedding and ignores others, whatever their names. A vector
    that is NULL, empty, zero, or holds NULL, NaN or infinite components has no links. Rows
    with one vec_id are one vertex with several vectors, and rows without vec_id are one that
    comes before all others; their component_id is NULL. An empty table gives an empty one.
    Long vectors are taken whole; a shard holds ``limit`` of them in a task's memory.
    """
    vec_id = F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID))
    rows = vectors.select(vec_id.alias("d"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = store(rows.withColumn("vec", F.when(_usable(F.col("vec")), F.col("vec"))), "rows")
    nodes = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.min("d").alias("first"), F.count("*").alias("m"))
    nodes = store(nodes.select(F.monotonically_increasing_id().alias("c"), "first", "m", "vec"), "nodes")
    for copies, margin in _OVERLAPS:
        found = _links(nodes, cosine, limit, copies, margin)
        counts = found.where("kind = 0").groupBy(F.col("a").alias("c")).agg(F.sum("w").alias("n"))
        recall = _recall(nodes, counts, cosine, audit)
        if recall >= target:
            break
    named = nodes.join(counts, "c", "left").select("vec", "first", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    rows = store(rows.join(named, "vec", "left").select("d", "first", F.coalesce("n_links", F.lit(0)).alias("n_links")), "counted")
    ties = rows.where("d != first").select(F.col("d").alias("a"), F.col("first").alias("b"))
    roots = components(found.where("kind = 1").select("a", "b").union(ties))
    out = rows.join(roots, "d", "left").withColumn("component", F.coalesce("root", "d"))
    return out.select(
        real_id("d").alias("vec_id"),
        F.col("n_links").cast("bigint").alias("n_links"),
        real_id("component").alias("component_id"),
        (F.col("d") == F.col("component")).alias("kept"),
        F.lit(float(recall)).alias("recall"),
    )


@query()
def op13_flat_graph_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings under a cosine of 0.95 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
