"""SimHash near-duplicates by shard BK-trees.

1. Every text gets a 64-bit fingerprint of its word shingles (Arrow batches).
2. Equal fingerprints become one row, so exact copies never meet each other.
3. Fingerprints within ``radius`` bits agree on whole bit blocks: with
   ``radius + 2`` blocks at least two are equal.  Each pair of blocks is a
   table, the value of its bits names a shard, and each fingerprint goes to its
   shard of every table.
4. In a shard a BK-tree (children keyed by integer Hamming distance to the
   parent) is built once and searched level by level for all shards of a batch
   at once; from a node at distance d only edges d - radius .. d + radius are
   followed.  What a search finds leaves the tree, so a dense group of m
   fingerprints gives some m links that span it, not m * m pairs.
5. Shards above ``shard_rows`` are split into sub-shards, every two of which
   are searched together, so no task holds a hot shard and no link is lost.
6. Link ends are contracted to components on the executors.

Edge cases: null and empty texts have fingerprint zero and link like any other;
a null doc_id keeps its row but never names a component (null only if a group
has no other id); repeated rows are kept; an empty table gives an empty result;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume.llm.common import columns_of, cut, slices, texts_of, whole_row, with_types
from plume.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
_AT_ONCE = 64


def shingle_hashes(text: bytes, width: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of each ``width``-word shingle, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    xx = xxhash.xxh64_intdigest
    if len(words) < width:
        return [xx(line, 42)]
    ends = list(accumulate([len(w) + 1 for w in words]))
    return [xx(line[a:b - 1], 42) for a, b in zip([0, *ends], ends[width - 1:])]


def fingerprints_of(texts: list[bytes], width: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64): a bit is 1 if set in over half of the hashes."""
    out = np.zeros(len(texts), dtype=np.uint64)
    for i, t in enumerate(texts):
        h = np.array(shingle_hashes(t, width), dtype=">u8")
        if len(h):
            ones = np.zeros(64, dtype=np.int64)
            for a in range(0, len(h), 1 << 15):
                ones += np.unpackbits(h[a:a + (1 << 15)].view(np.uint8)).reshape(-1, 64) \
                    .sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(ones * 2 > len(h)).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp bigint) for every row; the 64 bits are stored signed."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = fingerprints_of(texts_of(b, "text"), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    slim = with_types(docs.select("doc_id", "text"), doc_id="bigint", text="string")
    return slim.mapInArrow(rows, "doc_id bigint, fp bigint")


def block_masks(radius: int = RADIUS) -> list[int]:
    """Masks of every two of ``radius + 2`` bit blocks, as signed 64-bit."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = [x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


class Forest:
    """BK-trees of many shards in flat arrays; rows sorted by shard.

    A tree is built once.  A row that leaves it stays as a dead node whose edges
    are still followed while rows below it are alive (``below`` counts them).
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp = fp
        first = np.r_[True, shard[1:] != shard[:-1]] if n else np.empty(0, bool)
        self.root_of_shard = np.flatnonzero(first)
        size = np.diff(np.r_[self.root_of_shard, n])
        self.size = np.repeat(size, size)
        self.root = np.repeat(self.root_of_shard, size)
        self.parent = np.full(n, -1, np.int64)
        items, at = np.flatnonzero(~first), self.root[~first]
        keys, kids, levels = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
        while len(items):
            # an edge is the parent and the integer distance to it
            key = at * 128 + np.bitwise_count(fp[items] ^ fp[at]).astype(np.int64)
            edge, lead, where = np.unique(key, return_index=True, return_inverse=True)
            child = items[lead]
            self.parent[child] = at[lead]
            keys.append(edge)
            kids.append(child)
            levels.append(child)
            rest = np.ones(len(items), bool)
            rest[lead] = False
            items, at = items[rest], child[where[rest]]
        key, kid = np.concatenate(keys), np.concatenate(kids)
        order = np.argsort(key)
        self.kid = kid[order].astype(np.int32)
        # the first child of a node at a distance or more: distances 0..65 side by side
        at = key[order] // 128 * 66 + key[order] % 128
        self.first = np.zeros(66 * n + 1, np.int32)
        self.first[1:] = np.cumsum(np.bincount(at, minlength=66 * n))
        self.alive = np.ones(n, bool)
        self.below = np.ones(n, np.int64)  # living rows at and below a node
        for child in reversed(levels):  # the deepest first
            np.add.at(self.below, self.parent[child], self.below[child])

    def remove(self, rows: np.ndarray) -> None:
        """Rows (each once, alive) leave the tree."""
        self.alive[rows] = False
        while len(rows):
            np.subtract.at(self.below, rows, 1)
            rows = self.parent[rows]
            rows = rows[rows >= 0]

    def search(self, row: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query place, row) of every other living row within ``radius`` of the
        given rows, in their shards."""
        query, node = np.arange(len(row)), self.root[row]
        on = self.below[node] > 0
        query, node = query[on], node[on]
        found_q, found_n = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(query):
            d = np.bitwise_count(self.fp[node] ^ self.fp[row[query]]).astype(np.int64)
            hit = (d <= radius) & self.alive[node] & (node != row[query])
            found_q.append(query[hit])
            found_n.append(node[hit])
            lo = self.first[node * 66 + np.maximum(d - radius, 0)]
            many = self.first[node * 66 + np.minimum(d + radius, 64) + 1] - lo
            query = np.repeat(query, many)
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            node = self.kid[np.repeat(lo, many) + step]
            on = self.below[node] > 0
            query, node = query[on], node[on]
        return np.concatenate(found_q), np.concatenate(found_n)


def _first_per_run(sorted_keys: np.ndarray, at_most: int) -> np.ndarray:
    """Mask of the first ``at_most`` rows of each run of equal keys."""
    n = len(sorted_keys)
    start = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if n else np.empty(0, int)
    place = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
    return place < at_most


#: nodes that the queries of one search may stand on together (memory, not results)
_FRONTIER = 1 << 21
#: a query that finds more rows starts a group that its shard closes first
_HEAVY = 64


def spanning_links(shard: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (row numbers) that span the components of every shard.

    Every row asks the tree once and then leaves it, many rows of a shard at a
    time: of two linked rows the one that asks first finds the other, and so does
    each if they ask together.  That alone would give all pairs of a dense group.
    So a row that finds more than ``_HEAVY`` others has its shard to itself: what
    it finds leaves the tree at once and asks next, what that finds likewise,
    until the group finds nothing more; a group of m rows then gives some m
    links.  No row outside the group asks meanwhile, so no link to it is lost.
    """
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    tree = Forest(shard, fp[order])
    n_rows = len(order)
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    queue = np.empty(0, np.int64)  # found by the group that has its shard, sorted
    fresh = np.arange(n_rows)
    at_once = _AT_ONCE
    while True:
        queue = queue[tree.below[tree.root[queue]] > 0]  # nothing left to find
        fresh = fresh[tree.alive[fresh]]
        if not len(queue) and not len(fresh):
            break
        held = np.zeros(n_rows, bool)
        held[tree.root[queue]] = True
        seeds = fresh[~held[tree.root[fresh]]]
        row = np.sort(np.r_[queue[_first_per_run(shard[queue], at_once)],
                            seeds[_first_per_run(shard[seeds], at_once)]])
        row = row[:max(1, int(np.searchsorted(np.cumsum(tree.size[row]), _FRONTIER)))]
        seed = ~held[tree.root[row]]
        q, n = tree.search(row, radius)
        many = np.bincount(q, minlength=len(row))
        heavy = np.flatnonzero(seed & (many > _HEAVY))
        first = np.zeros(len(row), bool)
        first[heavy[_first_per_run(shard[row[heavy]], 1)]] = True
        later = seed & (many > _HEAVY) & ~first  # these stay in the tree and ask again
        told = ~later[q]
        q, n = q[told], n[told]
        out_a.append(row[q])
        out_b.append(n)
        done = np.zeros(n_rows, bool)
        done[row[~later]] = True
        mine = np.zeros(n_rows, bool)
        mine[n[(first | ~seed)[q]]] = True  # found by a group that has its shard
        gone = (done | mine) & tree.alive
        tree.remove(np.flatnonzero(gone))
        queue = np.sort(np.r_[queue[~done[queue]], np.flatnonzero(mine & ~done)])
        at_once = min(2 * at_once, 1 << 16) if len(n) <= 4 * len(row) and not later.any() else _AT_ONCE
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    keep = spanning_forest(n_rows, a, b)
    return order[a[keep]], order[b[keep]]


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of links that join the same rows without a cycle: each group
    takes its first link to another group, round by round."""
    group, kept = np.arange(n), [np.empty(0, np.int64)]
    open_ = np.arange(len(a))
    while True:
        x, y = group[a[open_]], group[b[open_]]
        open_, x, y = open_[x != y], x[x != y], y[x != y]
        if not len(open_):
            return np.sort(np.concatenate(kept))
        first = np.full(n, len(a), np.int64)
        np.minimum.at(first, x, open_)
        np.minimum.at(first, y, open_)
        took = np.unique(first[first < len(a)])
        kept.append(took)
        # a group points at the other end of its link; the smaller of two that
        # chose each other is the root
        up = np.arange(n)
        has = np.flatnonzero(first < len(a))
        ends = group[a[first[has]]], group[b[first[has]]]
        up[has] = np.where(ends[0] == has, ends[1], ends[0])
        mutual = (up[up] == np.arange(n)) & (np.arange(n) < up)
        up[mutual] = np.flatnonzero(mutual)
        while (up[up] != up).any():
            up = up[up]
        group = up[group]


def _shard_links(batches: Iterator[pa.RecordBatch], radius: int, at_least: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of whole shards; rows arrive sorted by ``unit``."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = 0

    def links(parts) -> pa.RecordBatch:
        t, k, f = (np.concatenate(x) for x in zip(*parts))
        new = np.r_[True, (t[1:] != t[:-1]) | (k[1:] != k[:-1])]
        a, b = spanning_links(np.cumsum(new), f.view(np.uint64), radius)
        return pa.RecordBatch.from_arrays([pa.array(f[a]), pa.array(f[b])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        got = tuple(np.asarray(batch.column(i)).astype(np.int64) for i in range(3))
        held.append(got)
        rows += batch.num_rows
        if rows < at_least:
            continue
        t, k, f = (np.concatenate(x) for x in zip(*held))
        last = np.flatnonzero((t == t[-1]) & (k == k[-1]))[0]  # the last shard may go on
        if last:
            yield links([(t[:last], k[:last], f[:last])])
        held, rows = [(t[last:], k[last:], f[last:])], len(t) - last
    if held:
        yield links(held)


def fingerprint_links(reps: DataFrame, radius: int = RADIUS, shard_rows: int = 20_000) -> DataFrame:
    """(a, b) links that span the components of distinct fingerprints ``fp``."""
    masks = block_masks(radius)
    keyed = reps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in masks])).alias("part", "value"))
    hot = keyed.groupBy("part", "value").count().filter(F.col("count") > shard_rows) \
        .select("part", "value", F.ceil(F.col("count") / shard_rows).alias("subs"))
    split = keyed.join(hot, ["part", "value"], "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("subs"))

    def pair(j: Column) -> Column:  # the sub-shard pair as one number
        return F.least(mine, j) * F.col("subs") + F.greatest(mine, j)

    pairs = F.when(F.col("subs").isNull(), F.array(F.lit(0).cast("bigint"))) \
        .otherwise(F.transform(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("subs"), F.lit(1)) - 1), pair))
    units = split.select("part", "value", "fp", F.explode(pairs).alias("pair")) \
        .select(F.col("part").cast("bigint"), F.xxhash64("part", "value", "pair").alias("unit"), "fp")
    return units.repartition("part", "unit").sortWithinPartitions("part", "unit", "fp") \
        .mapInArrow(lambda b: _shard_links(b, radius, 100_000), "a bigint, b bigint")


def _grouped(docs: DataFrame, width: int, radius: int, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root) of every distinct fingerprint."""
    prints = cut(fingerprints(docs, width))
    reps = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(fingerprint_links(reps, radius, shard_rows), "a", "b")
    return prints, reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS,
                    shard_rows: int = 20_000) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    prints, named = _grouped(docs, width, radius, shard_rows)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS,
             shard_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest
    doc_id (nulls last, then the smaller fingerprint); all columns unchanged.

    An id that stands on one row finds its row by itself.  Rows whose id is null
    or repeated are told apart by their fingerprint, taken again for them only,
    and of equal ones one stays.
    """
    prints, named = _grouped(docs, width, radius, shard_rows)
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "fp"))
    stay = cut(named.groupBy("root").agg(first.alias("s")).select("s.least", "s.fp"))
    often = cut(prints.groupBy("doc_id").count().filter("doc_id is null or count > 1").select("doc_id"))
    names = docs.columns
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id_"), F.col("text").cast("string").alias("text_"),
                       whole_row(docs).alias("row_"))
    once = stay.join(often, F.col("least") == F.col("doc_id"), "left_anti").filter("least is not null")
    plain = rows.join(once.select(F.col("least").alias("id_")), "id_", "left_semi").select("row_")
    if often.isEmpty():  # every id stands on one row
        return plain.select(*columns_of("row_", names))
    unsure = rows.join(often, F.col("id_").eqNullSafe(F.col("doc_id")), "left_semi")

    def with_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text_"):
            fp = fingerprints_of(texts_of(b, "text_"), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp)], ["id_", "row_", "fp_"])

    schema = unsure.select("id_", "row_").schema.add("fp_", T.LongType())
    told = unsure.mapInArrow(with_print, schema).join(
        stay, F.col("id_").eqNullSafe(F.col("least")) & (F.col("fp_") == F.col("fp")), "left_semi")
    told = told.dropDuplicates(["id_", "fp_"]).select("row_")
    return plain.unionByName(told).select(*columns_of("row_", names))
