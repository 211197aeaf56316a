"""Token ids packed into fixed-length rows by best-fit decreasing.

Texts become token ids of a public byte-level vocabulary.  A document longer
than a row is split losslessly: whole rows first, the rest is a piece like any
other.  Pieces are taken longest first; each goes to the open row with the least
free room that still holds it, found by descending a segment tree over free
room.  A chunk holds a bounded number of tokens, so a task's memory is bounded,
and chunks follow the order of a partition, so a re-run task packs alike.

A packed row is one row of the id matrix (little-endian 32-bit ids, padded),
with cumulative segment lengths (starting at 0, ending at the tokens used),
position ids that restart at every segment, and each segment's row key, document
and offset in it.  The key tells input rows apart whatever their ids, so every
row's tokens can be put together again.

Edge cases: null and empty texts have no tokens and are in no row; a null doc_id
is kept as null; ties in length are broken by doc_id, row key and offset;
repeated and null ids are rows of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import ints_of, slices, texts_of, with_types

#: the split pattern of byte-level vocabularies of this family (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class RoomTree:
    """Open rows by free room: a segment tree over room 0..length."""

    def __init__(self, length: int):
        self.base = 1 << length.bit_length()
        self.count = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.base
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of an open row with the least room >= ``need``."""
        at, count = need + self.base, self.count
        if not count[at]:
            # climb to the first right neighbour that holds a row, then go down
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.base:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.base
        row = self.rows[room].pop()
        while at:
            count[at] -= 1
            at >>= 1
        return room, row


def best_fit_decreasing(sizes: np.ndarray, length: int) -> np.ndarray:
    """Row number of each piece (1..length tokens); equal sizes in given order."""
    out = np.empty(len(sizes), np.int64)
    tree, rows = RoomTree(length), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        need = int(sizes[i])
        got = tree.take(need)
        room, row = got if got else (length, rows)
        rows += got is None
        out[i] = row
        if room > need:
            tree.add(room - need, row)
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=1)
def _encoder(ranks: tuple):
    import tiktoken

    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=dict(ranks), special_tokens={})


def encode_texts(texts: list[bytes], encoder) -> tuple[np.ndarray, np.ndarray]:
    """(ids, tokens per text), equal to encoding each text as a whole.

    Between a visible character and a single space followed by a visible one the
    pattern always splits, so such texts are encoded by distinct space + word.
    """
    units: list[str] = []
    many = np.zeros(len(texts), np.int64)
    for i, raw in enumerate(texts):
        t = raw.decode("utf-8", "replace")
        if t:
            words = t.split(" ")
            plain = all(w and not w[0].isspace() and not w[-1].isspace() for w in words)
            own = [words[0], *[" " + w for w in words[1:]]] if plain else [t]
            many[i] = len(own)
            units += own
    if not units:
        return np.empty(0, np.int32), many
    code, distinct = pd.factorize(np.array(units, dtype=object))
    ids = [encoder.encode_ordinary(u) for u in distinct]
    size = np.fromiter((len(x) for x in ids), np.int64, len(ids))
    flat = np.fromiter((t for x in ids for t in x), np.int32, int(size.sum()))
    start = np.cumsum(size) - size
    of = size[code]
    end = np.cumsum(of)
    at = np.repeat(start[code] - (end - of), of) + np.arange(end[-1])
    return flat[at], np.bincount(np.repeat(np.arange(len(texts)), many), of, len(texts)).astype(np.int64)


_PACKED = pa.schema([("pack", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()),
                     ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_offsets", pa.list_(pa.int64())),
                     ("row_keys", pa.list_(pa.int64()))])


def pack_chunk(doc_ids: list, ids: np.ndarray, many: np.ndarray, length: int, pad: int,
               row_keys: np.ndarray | None = None) -> pa.RecordBatch:
    """Packed rows of one chunk of documents (``row_keys``: their places, if None)."""
    if row_keys is None:
        row_keys = np.arange(len(many))
    first = np.cumsum(many) - many
    pieces = -(-many // length)
    doc = np.repeat(np.arange(len(many)), pieces)
    k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    offset = k * length
    size = np.minimum(length, many[doc] - offset)
    key = np.array([-1 if d is None else d for d in doc_ids], np.int64)[doc]
    order = np.lexsort((offset, row_keys[doc], key))
    row = np.empty(len(size), np.int64)
    row[order] = best_fit_decreasing(size[order], length)
    n_rows = int(row.max(initial=-1)) + 1
    order = np.lexsort((offset, row_keys[doc], key, -size, row))
    r, s, o, d = row[order], size[order], offset[order], doc[order]
    begin = np.cumsum(s) - s
    head = np.searchsorted(r, np.arange(n_rows))
    inside = begin - np.repeat(begin[head], np.diff(np.r_[head, len(r)]))
    matrix = np.full((n_rows, length), pad, "<i4")
    places = np.zeros((n_rows, length), "<i4")
    step = np.arange(s.sum()) - np.repeat(begin, s)
    target = np.repeat(r * length + inside, s) + step
    matrix.ravel()[target] = ids[np.repeat(first[d] + o, s) + step]
    places.ravel()[target] = step
    tail = np.r_[head[1:], len(r)]
    out = {c: [] for c in _PACKED.names}
    for i, (a, b) in enumerate(zip(head.tolist(), tail.tolist())):
        cu = [0, *np.cumsum(s[a:b]).tolist()]
        for c, v in zip(_PACKED.names, (i, cu[-1], matrix[i].tobytes(), cu, places[i].tobytes(),
                                        [doc_ids[x] for x in d[a:b]], o[a:b].tolist(),
                                        row_keys[d[a:b]].tolist())):
            out[c].append(v)
    return pa.RecordBatch.from_pydict(out, schema=_PACKED)


def pack(docs: DataFrame, vocabulary: str, length: int = 2048, pad: int = 50256,
         chunk_tokens: int = 2 << 20) -> DataFrame:
    """Packed rows; ``pack`` numbers them (partition in the upper bits)."""
    ranks = docs.sparkSession.sparkContext.broadcast(tuple(load_ranks(vocabulary).items()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pack_chunk([x for h in held for x in h[0]], np.concatenate([h[1] for h in held]),
                              np.concatenate([h[2] for h in held]), length, pad,
                              np.concatenate([h[3] for h in held]))

        for b in slices(batches, "text"):
            held.append((b.column(0).to_pylist(), *encode_texts(texts_of(b, "text"), encoder), ints_of(b, "row_key")))
            if sum(len(h[1]) for h in held) >= chunk_tokens:
                yield flush()
                held = []
        if held:
            yield flush()

    slim = with_types(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_key")),
                      doc_id="bigint", text="string")
    packed = slim.mapInArrow(
        rows, "pack bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_ids binary, "
              "doc_ids array<bigint>, doc_offsets array<bigint>, row_keys array<bigint>")
    return packed.withColumn("pack", F.monotonically_increasing_id())


def unpack(packed: DataFrame) -> DataFrame:
    """(row_key, doc_id, doc_offset, ids binary) of every segment: the split
    undone but for joining a row's segments in order of ``doc_offset``."""
    segs = packed.select("ids", F.posexplode("doc_ids").alias("k", "doc_id"), "doc_offsets", "cu_seqlens", "row_keys")
    begin, end = F.get("cu_seqlens", F.col("k")), F.get("cu_seqlens", F.col("k") + 1)
    return segs.select(F.get("row_keys", F.col("k")).alias("row_key"), "doc_id", F.get("doc_offsets", F.col("k")).alias("doc_offset"),
                       F.substring("ids", begin * 4 + 1, (end - begin) * 4).alias("ids"))


def write_packed(packed: DataFrame, path: str, shards: int | None = None) -> None:
    """Write the matrix rows and their lengths to a shared folder (overwrites,
    so a repeated run is safe)."""
    out = packed.repartition(shards) if shards else packed
    out.write.mode("overwrite").parquet(path)
