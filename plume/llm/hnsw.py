"""Approximate nearest neighbours: a navigable small-world graph per shard.

Vectors are dealt to shards by hash.  In a shard every node draws a top layer;
on each layer nodes are linked in insertion order to diverse near nodes among
those inserted before (found by blocked matrix products, the shard being
bounded), links go both ways, and long neighbour lists are pruned by the same
diversity rule.  The graph is one row: the vectors and, per layer, flat arrays of
nodes and neighbours.  Blocks of queries meet every shard's graph; a search
descends the layers greedily and ends with a beam of ``ef`` on the lowest, for
all queries of a block at once.  A shard is searched by groups of query blocks, a
task each, whatever the number of queries.  Shard results are merged per query.

Every row is indexed.  Identical vectors are one node that carries the ``k + 1``
smallest ids, the only ones that can be in a result of ``k``.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, take no part; only vectors of one length
are compared; a query never finds rows with its own id; a query id with several
vectors is answered for each (``query_key``, a hash of the vector, tells the
answers apart), equal query rows once; a repeated candidate row counts as often
as it stands in the table; fewer candidates than ``k`` are all returned; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plume.llm.common import cut, splitmix
from plume.llm.ego_join import is_usable, matrix_of

LINKS = 16          # links a node makes on a layer; twice as many are kept
BUILD = 64          # candidates looked at when linking


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :]
                      - 2 * a @ np.swapaxes(b, -1, -2), 0)


def _diverse(x: np.ndarray, cand: np.ndarray, dist: np.ndarray, most: int,
             fixed: np.ndarray | None = None) -> np.ndarray:
    """Of each row's candidates (sorted by distance, inf: none) take the
    ``fixed`` ones (fewer than ``most``, sorted first), and others only if
    nearer to the node than to all taken ones; fill up by distance."""
    if fixed is None:
        fixed = np.zeros(cand.shape, bool)
    pts = x[cand]
    between = _square_distances(pts, pts)
    taken = np.zeros(cand.shape, bool)
    nearest = np.full(cand.shape, np.inf)
    for k in range(cand.shape[1]):
        ok = np.isfinite(dist[:, k]) & (dist[:, k] <= nearest[:, k]) & (taken.sum(1) < most) | fixed[:, k]
        taken[:, k] = ok
        nearest = np.where(ok[:, None], np.minimum(nearest, between[:, k]), nearest)
    order = np.argsort(np.where(taken, 0, np.where(np.isfinite(dist), 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(cand, order, 1)
    out[~np.isfinite(np.take_along_axis(dist, order, 1))] = -1
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def link_layer(x: np.ndarray, links: int, step: int = 256) -> np.ndarray:
    """Neighbour array (n, 2 * links), -1 padded, of one layer's nodes."""
    n = len(x)
    c = min(BUILD, n)
    own = np.empty((n, links), np.int64)
    for a in range(0, n, step):
        b = min(n, a + step)
        d = _square_distances(x[a:b], x[:b])
        d[np.arange(b)[None, :] >= np.arange(a, b)[:, None]] = np.inf  # only earlier nodes
        k = min(c, b)
        cand = np.argpartition(d, k - 1, axis=1)[:, :k]
        dist = np.take_along_axis(d, cand, 1)
        order = np.argsort(dist, axis=1, kind="stable")
        own[a:b] = _diverse(x, np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1), links)
    stem = _stems(own, links)
    i, j = np.nonzero(own >= 0)
    i, near = np.r_[i, np.arange(1, n)], np.r_[own[i, j], stem[1:]]
    src, dst = np.r_[i, near], np.r_[near, i]
    # a stem stays in both lists, so every node can be reached from every other
    fixed = (stem[src] == dst) | (stem[dst] == src)
    pair, lead = np.unique(src * n + dst, return_index=True)
    src, dst, fixed = pair // n, pair % n, fixed[lead]
    d = ((x[src] - x[dst]) ** 2).sum(1)
    order = np.lexsort((dst, d, ~fixed, src))
    src, dst, d, fixed = src[order], dst[order], d[order], fixed[order]
    place = np.arange(len(src)) - np.searchsorted(src, src)
    width = int(min(3 * BUILD, place.max(initial=0) + 1))
    cand, dist, keep = np.zeros((n, width), np.int64), np.full((n, width), np.inf), np.zeros((n, width), bool)
    ok = place < width
    cand[src[ok], place[ok]], dist[src[ok], place[ok]], keep[src[ok], place[ok]] = dst[ok], d[ok], fixed[ok]
    out = np.empty((n, 2 * links), np.int64)
    for a in range(0, n, step):
        b = min(n, a + step)
        out[a:b] = _diverse(x, cand[a:b], dist[a:b], 2 * links, keep[a:b])
    return out


def _stems(own: np.ndarray, links: int) -> np.ndarray:
    """One earlier node per node (-1 for the first) that at most ``links`` nodes
    share: its nearest linked node with room, else one below the nearest.

    Stems are a tree over all nodes; a list of ``2 * links`` holds all of a
    node's, so pruning can keep them whatever else it drops.
    """
    n = len(own)
    stem, kids = np.full(n, -1, np.int64), [[] for _ in range(n)]
    for i in range(1, n):
        todo = [int(v) for v in own[i] if v >= 0]
        at = next((v for v in todo if len(kids[v]) < links), -1)
        while at < 0:  # the nearest nodes are full: look below them
            todo = [k for v in todo for k in kids[v]]
            at = next((v for v in todo if len(kids[v]) < links), -1)
        stem[i] = at
        kids[at].append(i)
    return stem


def build_graph(x: np.ndarray, links: int = LINKS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the lowest up: (node rows, neighbour rows) as flat arrays."""
    u = (splitmix(np.arange(len(x), dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
    top = np.floor(-np.log(np.maximum(u, 1e-300)) / np.log(links)).astype(int)
    layers = []
    for level in range(top.max(initial=0) + 1):
        nodes = np.flatnonzero(top >= level)
        local = link_layer(x[nodes], links)
        layers.append((nodes, np.where(local >= 0, nodes[local], -1)))
    return layers


def _beam(x: np.ndarray, queries: np.ndarray, row_of: np.ndarray, near: np.ndarray,
          ids: np.ndarray, dist: np.ndarray, ef: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search on one layer for all queries; the beam holds ``ef``."""
    nq = len(queries)
    seen = np.zeros((nq, len(x)), bool)
    rows = np.arange(nq)[:, None]
    ok = ids >= 0
    seen[np.nonzero(ok)[0], ids[ok]] = True
    done = ~ok
    while True:
        rank = np.where(done, np.inf, dist)
        live = np.flatnonzero(np.isfinite(rank).any(axis=1))
        if not len(live):
            return ids, dist
        pick = np.argsort(rank[live], axis=1, kind="stable")[:, :at_once]
        use = np.isfinite(np.take_along_axis(rank[live], pick, 1))
        done[live[:, None], pick] |= use
        src = np.take_along_axis(ids[live], pick, 1)
        new = np.where(use[..., None], near[row_of[src]], -1).reshape(len(live), -1)
        new = np.where((new >= 0) & ~seen[live[:, None], new], new, -1)
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        q, k = np.nonzero(new >= 0)
        d = np.full(new.shape, np.inf)
        diff = x[new[q, k]] - queries[live[q]]
        d[q, k] = (diff * diff).sum(axis=1)
        seen[live[q], new[q, k]] = True
        all_d = np.concatenate([dist[live], d], axis=1)
        all_i = np.concatenate([ids[live], new], axis=1)
        all_x = np.concatenate([done[live], new < 0], axis=1)
        keep = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
        ids[live], dist[live] = np.take_along_axis(all_i, keep, 1), np.take_along_axis(all_d, keep, 1)
        done[live] = np.take_along_axis(all_x, keep, 1)


def search_graph(x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray,
                 ef: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, squared distances) of up to ``ef`` near nodes per query, sorted."""
    start = layers[-1][0][0]
    diff = x[start] - queries
    ids, dist = np.full((len(queries), 1), start), (diff * diff).sum(axis=1)[:, None]
    for level in range(len(layers) - 1, -1, -1):
        nodes, near = layers[level]
        row_of = np.full(len(x), -1, np.int64)
        row_of[nodes] = np.arange(len(nodes))
        width = ef if level == 0 else min(ef, 16)
        wide_i, wide_d = np.full((len(queries), width), -1), np.full((len(queries), width), np.inf)
        wide_i[:, :ids.shape[1]], wide_d[:, :ids.shape[1]] = ids[:, :width], dist[:, :width]
        ids, dist = _beam(x, queries, row_of, near, wide_i, wide_d, width)
    return ids, dist


def _graph_rows(table: pa.Table) -> pa.Table:
    """One shard (bounded rows) as one graph row."""
    x = matrix_of(table["vec"].combine_chunks())
    order = np.lexsort(x.T[::-1])
    # insertion order: scrambled, but the same in every run
    order = order[np.argsort(splitmix(np.arange(len(x), dtype=np.uint64)))]
    x = x[order]
    ids = table["ids"].combine_chunks().take(pa.array(order))
    layers = build_graph(x)
    return pa.Table.from_pylist([{
        "dim": x.shape[1], "shard": table["shard"][0].as_py(), "vecs": x.tobytes(),
        "ids": np.asarray(ids.flatten()).astype(np.int64).tobytes(),
        "many": np.asarray(pc.list_value_length(ids)).astype(np.int32).tobytes(),
        "nodes": [a.astype(np.int32).tobytes() for a, _ in layers],
        "near": [b.astype(np.int32).tobytes() for _, b in layers]}], schema=_GRAPH)


_GRAPH = pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("vecs", pa.binary()),
                    ("ids", pa.binary()), ("many", pa.binary()),
                    ("nodes", pa.list_(pa.binary())), ("near", pa.list_(pa.binary()))])


def shard_graphs(vectors: DataFrame, k: int, shard_rows: int) -> tuple[DataFrame, int]:
    """(graph rows, number of shards) over (vec_id, vec) rows."""
    copies = Window.partitionBy("vec").orderBy("vec_id")
    nodes = vectors.withColumn("place", F.row_number().over(copies)).filter(F.col("place") <= k + 1) \
        .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = nodes.select(F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec"), F.lit(shards)).alias("shard"), "vec", "ids")
    graphs = dealt.groupBy("dim", "shard").applyInArrow(
        _graph_rows, "dim int, shard bigint, vecs binary, ids binary, many binary, "
                     "nodes array<binary>, near array<binary>")
    return cut(graphs), shards


def _query_block(table: pa.Table) -> pa.Table:
    """One block of queries (bounded rows) as one row."""
    vec = table["vec"].combine_chunks()
    return pa.Table.from_pylist(
        [{"dim": table["dim"][0].as_py(), "block": table["block"][0].as_py(), "queries": matrix_of(vec).tobytes(),
          "query_ids": np.asarray(table["vec_id"]).astype(np.int64).tobytes(),
          "query_keys": np.asarray(table["query_key"]).astype(np.int64).tobytes()}],
        schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("query_ids", pa.binary()),
                          ("query_keys", pa.binary()), ("queries", pa.binary())]))


_FOUND = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(asked: pa.Table, graph: pa.Table, k: int, ef: int) -> pa.Table:
    """The ``k`` best rows of one shard for a group of query blocks."""
    if not asked.num_rows or not graph.num_rows:
        return _FOUND.empty_table()
    g = graph.to_pylist()[0]
    x = np.frombuffer(g["vecs"], np.float64).reshape(-1, g["dim"])
    layers = [(np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(b, np.int32).astype(np.int64)
               .reshape(-1, 2 * LINKS)) for a, b in zip(g["nodes"], g["near"])]
    many, ids = np.frombuffer(g["many"], np.int32).astype(np.int64), np.frombuffer(g["ids"], np.int64)
    start = np.cumsum(many) - many
    out = []
    for row in asked.to_pylist():
        queries = np.frombuffer(row["queries"], np.float64).reshape(-1, g["dim"])
        qid, key = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["query_keys"], np.int64)
        found, dist = search_graph(x, layers, queries, min(ef, max(len(x), k + 1)))
        # every copy of a found node, then the k best rows of each query
        q, c = np.nonzero(found >= 0)
        node = found[q, c]
        at = np.repeat(start[node], many[node]) + np.arange(many[node].sum()) \
            - np.repeat(np.cumsum(many[node]) - many[node], many[node])
        q, score, vid = np.repeat(q, many[node]), np.sqrt(np.repeat(dist[q, c], many[node])), ids[at]
        other = vid != qid[q]
        q, score, vid = q[other], score[other], vid[other]
        order = np.lexsort((vid, score, q))
        q, score, vid = q[order], score[order], vid[order]
        near = np.arange(len(q)) - np.searchsorted(q, q) < k
        q, score, vid = q[near], score[near], vid[near]
        out.append(pa.table([qid[q], key[q], vid, score], schema=_FOUND))
    return pa.concat_tables(out)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = 10, ef: int = 96, shard_rows: int = 5_000, block: int = 512,
            group: int = 8) -> DataFrame:
    """(query_id, rank, vec_id, score, query_key): up to ``k`` nearest rows per
    query by Euclidean distance, ties to the smaller id."""
    rows = vectors.withColumn("_asks", F.coalesce(is_query, F.lit(False))) \
        .select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec"), "_asks") \
        .filter(F.col("vec_id").isNotNull() & is_usable(F.col("vec")))
    graphs, shards = shard_graphs(rows.select("vec_id", "vec"), k, shard_rows)
    asks = rows.filter("_asks")
    blocks = max(1, -(-asks.count() // block))
    asked = asks.select("vec_id", "vec").distinct().select(
        F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).alias("block"), "vec_id", "vec",
        F.xxhash64("vec").alias("query_key")).groupBy("dim", "block").applyInArrow(
        _query_block, "dim int, block bigint, query_ids binary, query_keys binary, queries binary")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    # a group of blocks meets each shard's graph in a task of its own
    meet = asked.withColumn("shard", each(shards)).withColumn("part", F.floor(F.col("block") / F.lit(group)))
    held = graphs.withColumn("part", each(-(-blocks // group)))
    found = meet.groupBy("dim", "shard", "part").cogroup(held.groupBy("dim", "shard", "part")).applyInArrow(
        lambda a, g: _search(a, g, k, ef), "query_id bigint, query_key bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score", "query_key")
