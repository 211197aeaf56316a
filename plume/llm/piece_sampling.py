"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text's pieces form a lattice over its bytes; a path is a segmentation and its
weight the product of its pieces' probabilities.  Forward filtering sums path
weights from the left; sampling walks back from the end, choosing each piece in
proportion to the filtered weight it comes from.  Random numbers are a function
of (seed, row key, place in the text) alone, so a row's sample never depends on
partitions, batches or retries.

The model is a public piece vocabulary with byte fallback.  It states merge
ranks, not probabilities, so a piece's weight follows its rank (1 / (rank + 1),
raised to ``sharpness``).  White space is a piece symbol; no piece goes on after
a word into white space, so the lattice falls apart into units (a run of spaces
and the word after it) that are filtered once per batch and then sampled side
by side for all their occurrences.

Encoding takes the text as it is (no normalisation) behind one added space;
characters without a piece become byte pieces.  Decoding joins the pieces' bytes
and drops that space: it gives back every text exactly.

Edge cases: null and empty texts have no pieces (null decodes as empty); a null
doc_id has the key 0; repeated rows get the same sample; texts of any length are
encoded whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume.llm.common import columns_of, ints_of, slices, splitmix, texts_of, with_types
from plume.llm.trie import ByteTrie

SPACE = "▁"
_UNITS = re.compile(rb" +[^ ]*")


def load_pieces(path: str) -> tuple[list[tuple[bytes, int, int]], list[int]]:
    """((bytes, id, rank) of the ordinary pieces, ids of the 256 byte pieces)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, of_byte = [], [-1] * 256
    for i in range(sp.vocab_size()):
        if sp.is_byte(i):
            of_byte[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces.append((sp.id_to_piece(i).replace(SPACE, " ").encode(), i, int(-sp.get_score(i))))
    if min(of_byte) < 0:
        raise ValueError("lossless decoding needs a byte piece for every byte")
    # a piece with white space after other bytes would cross units
    return [p for p in pieces if b" " not in p[0].lstrip(b" ")], of_byte


class PieceModel:
    """Lattice tables and the decoding table of one vocabulary."""

    def __init__(self, pieces: list[tuple[bytes, int, int]], of_byte: list[int], sharpness: float = 1.0):
        self.trie = ByteTrie([(p, k) for k, (p, _, _) in enumerate(pieces)])
        self.ids = np.array([i for _, i, _ in pieces], np.int32)
        rank = np.array([r for _, _, r in pieces], np.float64)
        self.logp = -sharpness * np.log(np.maximum(rank, 0) + 1.0)
        self.of_byte = np.array(of_byte, np.int32)
        self.byte_logp = -sharpness * np.log(len(pieces) + 256.0)
        table = {i: p for p, i, _ in pieces} | {i: bytes([b]) for b, i in enumerate(of_byte)}
        size = max(table) + 1
        self.length = np.array([len(table.get(i, b"")) for i in range(size)], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(table.get(i, b"") for i in range(size)), np.uint8)

    def lattice(self, units: list[bytes]) -> dict[str, np.ndarray]:
        """All piece edges of the units and, per end node, the running share of
        forward weight of the edges that enter it.

        Node of byte place p in unit u: offset[u] + u + p (a unit of n bytes has
        n + 1 nodes).  Edges are sorted by end node.
        """
        size = np.fromiter((len(u) for u in units), np.int64, len(units))
        flat = np.frombuffer(b"".join(units), np.uint8)
        first = np.cumsum(size) - size
        n = len(flat)
        unit = np.repeat(np.arange(len(units), dtype=np.int32), size)
        every = np.arange(n, dtype=np.int32)  # a slice has far fewer than 2^31 bytes
        room = (first + size).astype(np.int32)[unit] - every  # bytes left in the unit
        lead = (flat & 0xC0) != 0x80
        width = np.where(flat < 0x80, 1, np.where(flat < 0xE0, 2, np.where(flat < 0xF0, 3, 4)))
        known = np.zeros(n, bool)  # the character that starts here is a piece
        at, state, depth = every, np.zeros(n, np.int32), 0
        src, dst, piece = [], [], []
        while len(at):
            depth += 1
            state = self.trie.next[state, flat[at + depth - 1]]
            ok = state > 0
            at, state = at[ok], state[ok]
            entry = self.trie.entry[state]
            hit = entry >= 0
            src.append(at[hit])
            dst.append(at[hit] + depth)
            piece.append(entry[hit])
            known[at[hit & (width[at] == depth)]] = True
            go = room[at] > depth
            at, state = at[go], state[go]
        place = np.where(lead, every, 0)
        bare = np.flatnonzero(~known[np.maximum.accumulate(place)] if n else known).astype(np.int32)
        src.append(bare)
        dst.append(bare + 1)
        src, dst, piece = np.concatenate(src), np.concatenate(dst), np.concatenate(piece)
        ids = np.r_[self.ids[piece], self.of_byte[flat[bare]]]
        logp = np.r_[self.logp[piece], np.full(len(bare), self.byte_logp)]
        src_node, dst_node = src + unit[src], dst + unit[src]
        rel = dst - first.astype(np.int32)[unit[src]]
        del room, place, known, src, dst, piece
        order = np.lexsort((dst_node, rel))
        src_node, dst_node, ids, logp, rel = (x[order] for x in (src_node, dst_node, ids, logp, rel))
        alpha = np.zeros(n + len(units))
        new = np.flatnonzero(np.r_[True, dst_node[1:] != dst_node[:-1]]) if len(dst_node) else np.empty(0, np.int64)
        group = np.repeat(np.arange(len(new), dtype=np.int32), np.diff(np.r_[new, len(dst_node)]))
        share = np.empty(len(logp))
        # forward filtering, one byte place of all units at a time
        cuts = np.flatnonzero(np.r_[True, rel[1:] != rel[:-1]]) if len(rel) else np.empty(0, np.int64)
        gcut = np.searchsorted(new, np.r_[cuts, len(rel)])
        for k, (a, b) in enumerate(zip(cuts, np.r_[cuts[1:], len(rel)])):
            heads = new[gcut[k]:gcut[k + 1]] - a
            w = alpha[src_node[a:b]] + logp[a:b]
            top = np.maximum.reduceat(w, heads)
            g = group[a:b] - gcut[k]
            w = np.exp(w - top[g])
            total = np.add.reduceat(w, heads)
            alpha[dst_node[a + heads]] = top + np.log(total)
            run = np.cumsum(w / total[g])
            share[a:b] = run - np.r_[0.0, run][heads][g]
        if len(new):
            share[np.r_[new[1:], len(logp)] - 1] = 1.0  # the last edge of a node takes the rest
        group_of = np.full(n + len(units), -1, np.int32)
        group_of[dst_node[new]] = np.arange(len(new))
        return {"share": share, "src": src_node, "ids": ids, "group_of": group_of, "first": new,
                "start": first + np.arange(len(units)), "size": size}

    def sample(self, texts: list[bytes], row_key: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, piece count per text) of one sampled segmentation each."""
        units: list[bytes] = []
        many = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                if b"  " in t or t[:1] == b" " or t[-1:] == b" ":
                    own = _UNITS.findall(b" " + t)
                else:
                    own = [b" " + w for w in t.split(b" ")]
                many[i] = len(own)
                units += own
        if not units:
            return np.empty(0, np.int32), many
        code, distinct = pd.factorize(np.array(units, dtype=object))
        del units
        lat = self.lattice(list(distinct))
        text = np.repeat(np.arange(len(texts)), many)
        place = np.cumsum(lat["size"][code]) - lat["size"][code]
        head = np.r_[0, np.cumsum(many)][:-1]
        place -= np.repeat(place[np.minimum(head, len(place) - 1)], many)  # of the unit in its text
        salt = splitmix(splitmix(row_key.astype(np.uint64)) ^ np.uint64(seed))[text]
        start, steps = lat["start"][code], []
        live, node = np.arange(len(code)), lat["start"][code] + lat["size"][code]
        pieces = np.zeros(len(code), np.int64)
        while len(live):
            with np.errstate(over="ignore"):
                bits = splitmix(salt[live] + (place[live] + node - start[live]).astype(np.uint64)
                                * np.uint64(0xD1B54A32D192ED03))
            u = (bits >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
            g = lat["group_of"][node]
            e = lat["first"][g]
            more = np.flatnonzero(lat["share"][e] <= u)  # few edges enter a node: step to the drawn one
            while len(more):
                e[more] += 1
                more = more[lat["share"][e[more]] <= u[more]]
            steps.append((live, lat["ids"][e]))
            pieces[live] += 1
            node = lat["src"][e]
            on = node > start[live]
            live, node = live[on], node[on]
        end = np.cumsum(pieces)
        ids = np.empty(end[-1], np.int32)
        for k, (at, got) in enumerate(steps):  # pieces come last first
            ids[end[at] - 1 - k] = got
        return ids, np.bincount(text, pieces, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, many: np.ndarray) -> list[bytes]:
        """The texts back from their piece ids."""
        size = self.length[ids]
        end = np.cumsum(size)
        at = np.repeat(self.start[ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
        data = self.bytes[at].tobytes()
        cut = np.r_[0, end][np.r_[0, np.cumsum(many)]]
        return [data[a + 1:b] if b > a else b"" for a, b in zip(cut.tolist(), cut[1:].tolist())]


@lru_cache(maxsize=1)
def _model(pieces: tuple, of_byte: tuple, sharpness: float) -> PieceModel:
    return PieceModel(list(pieces), list(of_byte), sharpness)


def _shared(spark, path: str):
    """The vocabulary, read by the driver, for all executors (about a megabyte)."""
    pieces, of_byte = load_pieces(path)
    return spark.sparkContext.broadcast((tuple(pieces), tuple(of_byte)))


def encode(docs: DataFrame, model_path: str, seed: int = 0, sharpness: float = 1.0,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_pieces, ids array<int>, lossless) and the ``keep`` columns for
    every row.  Each batch's ids are decoded again: ``lossless`` says whether
    they gave back the text, byte for byte."""
    shared = _shared(docs.sparkSession, model_path)
    kept = docs.select(*keep)
    slim = with_types(docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"),
                                  F.struct(F.lit(0), *keep).alias("_kept")), _id="bigint", _text="string")
    schema = T.StructType().add("doc_id", T.LongType()).add("n_pieces", T.LongType()) \
        .add("ids", T.ArrayType(T.IntegerType())).add("lossless", T.BooleanType()) \
        .add("_kept", slim.schema["_kept"].dataType)
    names = schema.names

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(*shared.value, sharpness)
        for b in slices(batches, "_text", 1 << 20):  # a lattice takes about a hundred times its text
            texts = texts_of(b, "_text")
            ids, many = model.sample(texts, ints_of(b, "_id", 0), seed)
            same = [x == y for x, y in zip(model.decode(ids.astype(np.int64), many), texts)]
            offsets = pa.array(np.r_[0, np.cumsum(many)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(many), pa.ListArray.from_arrays(offsets, pa.array(ids)),
                 pa.array(same, pa.bool_()), b.column(2)], names)

    return slim.mapInArrow(rows, schema).select(*names[:4], *columns_of("_kept", kept.columns))


def decode(encoded: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``text`` back from ``ids``; null ids are an empty text."""
    shared = _shared(encoded.sparkSession, model_path)
    slim = encoded.select(*keep, "ids")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(*shared.value, 1.0)
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(b.schema.get_field_index("ids"))
            many = np.asarray(pc.list_value_length(col).fill_null(0)).astype(np.int64)
            texts = model.decode(np.asarray(col.flatten()).astype(np.int64), many)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(keep))],
                 pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], [*keep, "text"])

    schema = slim.drop("ids").schema.add("text", T.StringType())
    return slim.mapInArrow(rows, schema)
