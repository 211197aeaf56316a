"""Sharding of documents by best-fit-decreasing bin packing.

Rows with equal texts are one indivisible group.  Groups go longest first, each
into the open bin with the least free room that still holds it, found in a
balanced search tree over (room, bin); a new bin opens only where none holds it,
so bins of a fixed capacity stay few.

Two levels keep every task and the driver bounded.  Groups below 1 in
``n_shards * fine`` of all bytes and of all rows are packed into small bins of
that capacity, in hash buckets, from a sorted stream; a task holds its open bins
only.  The small bins and the larger groups (by their definition at most a few
``n_shards * fine`` of both) are then packed into shards, whose capacity is the
least that the packing makes do with ``n_shards`` bins of.  A group above a fair
share of the rest takes a shard of its own, as it can't be divided.  Up to
``n_shards * fine`` rows this is plain best-fit-decreasing of all groups.

Slots number a shard's rows by doc_id (range-partitioned, so a shard is many
tasks).  Equal inputs give equal shards and slots whatever the partitions.

Edge cases: a null text has no bytes and counts as an empty one; a null doc_id
comes first in its shard; repeated rows stay together and get slots each; fewer
groups than shards leave shards empty; an empty table gives an empty result;
other columns are kept by ``write_shards`` only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.llm.common import columns_of, cut, whole_row
from plume.operators.rank import dist_rank

#: bytes a row takes beside its text
OVERHEAD = 8
#: groups of a hash bucket while there are fewer buckets than small bins
_BUCKET_GROUPS = 2_000


class RoomTree:
    """Open bins ordered by (room, bin): a treap, whose pseudo-random priorities
    keep it balanced."""

    def __init__(self):
        self.key: list[tuple[int, int]] = []
        self.heap: list[int] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.root, self.free = -1, []

    def _split(self, node: int, key: tuple[int, int]) -> tuple[int, int]:
        """The trees of the keys below ``key`` and of the others."""
        if node < 0:
            return -1, -1
        if self.key[node] < key:
            self.right[node], high = self._split(self.right[node], key)
            return node, high
        low, self.left[node] = self._split(self.left[node], key)
        return low, node

    def _join(self, a: int, b: int) -> int:
        if a < 0 or b < 0:
            return max(a, b)
        if self.heap[a] > self.heap[b]:
            self.right[a] = self._join(self.right[a], b)
            return a
        self.left[b] = self._join(a, self.left[b])
        return b

    def add(self, room: int, number: int) -> None:
        key = (room, number)
        heap = (hash(key) * 0x9E3779B97F4A7C15 ^ number * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        if self.free:
            new = self.free.pop()
            self.key[new], self.heap[new], self.left[new], self.right[new] = key, heap, -1, -1
        else:
            new = len(self.key)
            for part, value in ((self.key, key), (self.heap, heap), (self.left, -1), (self.right, -1)):
                part.append(value)
        above, node = -1, self.root
        while node >= 0 and self.heap[node] >= heap:
            above, node = node, self.right[node] if self.key[node] < key else self.left[node]
        self.left[new], self.right[new] = self._split(node, key)
        self._hang(above, key, new)

    def _hang(self, above: int, key: tuple[int, int], node: int) -> None:
        if above < 0:
            self.root = node
        elif self.key[above] < key:
            self.right[above] = node
        else:
            self.left[above] = node

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the (room, bin) with the least room >= ``need``."""
        best, best_above, above, node = -1, -1, -1, self.root
        while node >= 0:
            if self.key[node][0] >= need:
                best, best_above = node, above
                above, node = node, self.left[node]
            else:
                above, node = node, self.right[node]
        if best < 0:
            return None
        key = self.key[best]
        self._hang(best_above, key, self._join(self.left[best], self.right[best]))
        self.free.append(best)
        return key


class Bins:
    """Bins of one capacity, filled best fit first."""

    def __init__(self, capacity: int):
        self.capacity, self.tree, self.count = capacity, RoomTree(), 0

    def put(self, size: int) -> int:
        """The bin that takes an item of at most ``capacity``."""
        got = self.tree.take(size)
        if got is None:
            got = (self.capacity, self.count)
            self.count += 1
        room, number = got
        if room > size:
            self.tree.add(room - size, number)
        return number


def pack_into(sizes: list[int], n_bins: int) -> list[int]:
    """Bin of each item (given longest first), ``n_bins`` at most, of the least
    capacity (to 1 in 10,000) that best-fit-decreasing does with.

    Items above the fair share of what is left take a bin of their own.
    """
    total, alone = sum(sizes), 0
    while alone < len(sizes) and n_bins - alone > 1 and sizes[alone] * (n_bins - alone) > total:
        total -= sizes[alone]
        alone += 1
    out, rest, n = list(range(alone)), sizes[alone:], n_bins - alone
    if not rest:
        return out

    def packed(capacity: int) -> list[int] | None:
        bins, to = Bins(capacity), []
        for s in rest:
            to.append(bins.put(s))
            if bins.count > n:
                return None
        return to

    low = max(rest[0], -(-total // n))
    high, best = 2 * low, None
    while best is None:  # twice the least possible capacity always does
        best, high = packed(high), high * 2
    high //= 2
    while high - low > low // 10_000:
        mid = (low + high) // 2
        got = packed(mid)
        if got is None:
            low = mid + 1
        else:
            best, high = got, mid
    return out + [alone + b for b in best]


def text_key(text: Column) -> Column:
    """Equal for equal texts, and for no others (SHA-256)."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def _small_bins(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Groups sorted by bucket, longest first -> their bin in the bucket."""
    bins, bucket = Bins(capacity), None
    for b in batches:
        out = []
        for at, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if at != bucket:
                bins, bucket = Bins(capacity), at
            out.append(bins.put(size))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.array(out, np.int64))],
                                         ["bucket", "bytes", "key", "bin"])


class Plan:
    """The shard of every group: ``large`` (key, shard), a bounded table, and
    ``small`` (key, shard), where no key holds many rows."""

    def __init__(self, rows: DataFrame, n_shards: int, fine: int):
        """``rows``: key, size."""
        spark = rows.sparkSession
        parts = n_shards * fine
        groups = cut(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
        all_ = groups.agg(F.sum("bytes"), F.sum("n"), F.count(F.lit(1))).first()
        total, n_rows, n_groups = (x or 0 for x in all_)
        capacity = total // parts
        is_large = (F.col("bytes") > capacity) | (F.col("n") > n_rows // parts)
        buckets = min(n_groups // _BUCKET_GROUPS + 1, parts)
        small = cut(
            groups.filter(~is_large)
            .select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "bytes", "key")
            .repartition("bucket").sortWithinPartitions("bucket", F.desc("bytes"), "key")
            .mapInArrow(lambda b: _small_bins(b, capacity), "bucket bigint, bytes bigint, key binary, bin bigint"))
        # fewer than 2 * parts large groups; a bucket leaves at most one bin that is not half full
        large = [(r["bytes"], bytes(r["key"])) for r in groups.filter(is_large).select("bytes", "key").collect()]
        bins = [(r["bytes"], (r["bucket"], r["bin"])) for r in
                small.groupBy("bucket", "bin").agg(F.sum("bytes").alias("bytes")).collect()]
        items = sorted(large, key=lambda x: (-x[0], x[1])) + sorted(bins, key=lambda x: (-x[0], x[1]))
        items.sort(key=lambda x: -x[0])  # stable
        shard = pack_into([s for s, _ in items], n_shards)
        of = list(zip([k for _, k in items], shard))
        self.large = spark.createDataFrame(
            [(bytearray(k), s) for k, s in of if isinstance(k, bytes)], "key binary, shard int")
        places = spark.createDataFrame([(*k, s) for k, s in of if not isinstance(k, bytes)],
                                       "bucket bigint, bin bigint, shard int")
        self.small = small.join(F.broadcast(places), ["bucket", "bin"]).select("key", "shard")

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``key``) and their ``shard``."""
        large = F.broadcast(self.large)
        few = rows.join(large, "key")
        return few.unionByName(rows.join(large.select("key"), "key", "left_anti").join(self.small, "key"))


def assign(docs: DataFrame, n_shards: int = 24, fine: int = 512) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_key(F.col("text")).alias("key")))
    placed = Plan(rows.select("key", "size"), n_shards, fine).apply(rows).drop("key") \
        .withColumn("_row", F.monotonically_increasing_id())  # spreads equal rows; which is which can't be seen
    placed = dist_rank(cut(placed), ["doc_id", "text_crc32", "size", "_row"], ["shard"], rank_col="_rank", size_col=None)
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("_rank") - 1).cast("bigint").alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, fine: int = 512) -> None:
    """Write whole rows, in folders by shard (overwrites, so a repeat is safe)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = docs.columns
    rows = docs.select(whole_row(docs).alias("row_"), text_key(F.col("text")).alias("key"),
                       (F.octet_length(text) + F.lit(OVERHEAD)).cast("bigint").alias("size"))
    placed = Plan(rows.select("key", "size"), n_shards, fine).apply(rows)
    placed.select(*columns_of("row_", [c for c in names if c != "shard"]), "shard") \
        .write.mode("overwrite").partitionBy("shard").parquet(path)
