"""Cross-tokenizer alignment of whole texts.

Both tokenizers encode a text; their tokens lie on one line of bytes (a space
and the text).  Per batch the tokens of both sides become two tables keyed by
document, and ``pandas.merge_asof`` finds for each token's start the other
side's token that covers it; the union of both directions is every overlapping
pair.  Overlaps whose ends are equal close a group: the tokens since the last
such end on both sides form it, and the two that end there are a link.

How often an id pair is linked is counted over the whole corpus.  A batch is a
block: it writes its documents (link by link the number of an id pair of the
block) and its distinct id pairs once to the shared folder.  Pairs are added up
over blocks, so a pair that is linked everywhere is one row a block, joined to
the totals, and brought back to their block, where each document reads its
links.  The links themselves are never joined.

Texts are encoded by distinct units (a space and the visible characters up to
the next single space), which a worker remembers up to a bound; between a visible character and a
single space followed by a visible one neither tokenizer has a token.

Edge cases: null and empty texts, and texts that either tokenizer does not give
back byte for byte, have no tokens: zeros and an empty digest; a null doc_id is
kept; repeated rows count each; texts of any length are encoded whole and are a
block of their own when long; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import cut, slices, texts_of, with_types

SPACE = "▁"
#: the split pattern of byte-level vocabularies of this family (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNIT = re.compile(r"(?<=\S)(?= \S)")


class Side:
    """One tokenizer: ``encode(units)`` gives ids per unit, ``bytes_of`` the
    bytes a token id stands for."""

    def __init__(self, encode, bytes_of: dict[int, bytes]):
        self.encode = encode
        size = max(bytes_of) + 1
        self.bytes_of = [bytes_of.get(i, b"") for i in range(size)]
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_side(definition: str) -> Side:
    """A byte-level tokenizer from the text of its JSON file.

    Where its merges stand in order of the ids they make, the vocabulary is a
    table of merge ranks, which is encoded several times faster.
    """
    import tiktoken
    import tokenizers

    t = tokenizers.Tokenizer.from_str(definition)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    of = _byte_alphabet()
    special = set(t.get_added_tokens_decoder())
    table = {i: bytes(of[c] for c in s) for s, i in t.get_vocab().items() if i not in special}
    parsed = json.loads(definition)
    merges = [m.split(" ") if isinstance(m, str) else m for m in parsed["model"]["merges"]]
    made = [parsed["model"]["vocab"].get(a + b, -1) for a, b in merges]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if parsed["pre_tokenizer"] == plain and not parsed["normalizer"] and made == list(range(256, 256 + len(made))):
        ranked = tiktoken.Encoding("aligned", pat_str=PATTERN, special_tokens={},
                                   mergeable_ranks={b: i for i, b in table.items()})
        return Side(lambda units: [ranked.encode_ordinary(u) for u in units], table)
    return Side(lambda units: [e.ids for e in t.encode_batch(units, add_special_tokens=False)], table)


def piece_side(model: bytes) -> Side:
    """A SentencePiece tokenizer, which adds the space before a text itself."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    table = {}
    for i in range(sp.vocab_size()):
        if sp.is_byte(i):
            table[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            table[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
    return Side(lambda units: sp.encode([u[1:] for u in units], num_threads=1), table)


class Units:
    """Distinct units and their tokens on both sides, kept over batches.

    A worker forgets all of them when there are ``most``: that bounds its memory
    and changes no result.
    """

    def __init__(self, sides: tuple[Side, Side], most: int = 300_000):
        self.sides, self.most = sides, most
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.exact = np.empty(0, bool)
        self.flat = [np.empty(0, np.int32) for _ in self.sides]
        self.start = [np.zeros(1, np.int64) for _ in self.sides]

    def codes(self, units: list[str]) -> np.ndarray:
        """The numbers of some units; new ones are encoded."""
        if len(self.code) > self.most:
            self.clear()
        known = len(self.code)
        code = self.code
        out = np.fromiter((code.setdefault(u, len(code)) for u in units), np.int64, len(units))
        if len(code) > known:
            new = list(code)[known:]
            raw = [u.encode() for u in new]
            exact = np.ones(len(new), bool)
            for k, side in enumerate(self.sides):
                ids = side.encode(new)
                of = side.bytes_of
                # does the unit come back byte for byte?
                exact &= np.array([b"".join([of[t] for t in x]) == r for x, r in zip(ids, raw)], bool)
                size = np.array([len(x) for x in ids], np.int64)
                self.flat[k] = np.concatenate([self.flat[k], np.array([t for x in ids for t in x], np.int32)])
                self.start[k] = np.concatenate([self.start[k], self.start[k][-1] + np.cumsum(size)])
            self.exact = np.concatenate([self.exact, exact])
        return out


class Tokens:
    """The tokens of one side for a batch of documents: document, byte range (on
    one line over all documents of the batch) and id, in order."""

    def __init__(self, units: Units, k: int, code: np.ndarray, many: np.ndarray):
        start, of = units.start[k][code], np.diff(units.start[k])[code]
        end = np.cumsum(of)
        at = np.repeat(start - (end - of), of) + np.arange(end[-1] if len(end) else 0)
        self.id = units.flat[k][at]
        self.doc = np.repeat(np.repeat(np.arange(len(many)), many), of)
        length = units.sides[k].length[self.id]
        self.end = np.cumsum(length)
        self.start = self.end - length

    def keep(self, good: np.ndarray) -> None:
        """Drop the documents that are not ``good``; ranges keep their places."""
        on = good[self.doc]
        self.id, self.doc, self.start, self.end = (x[on] for x in (self.id, self.doc, self.start, self.end))

    def move(self, base: np.ndarray) -> None:
        """Put every document's first byte at its place ``base``."""
        first = np.flatnonzero(np.r_[True, self.doc[1:] != self.doc[:-1]]) if len(self.doc) else np.empty(0, int)
        by = (base[self.doc[first]] - self.start[first]).repeat(np.diff(np.r_[first, len(self.doc)]))
        self.start, self.end = self.start + by, self.end + by

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"start": self.start, "doc": self.doc, name: np.arange(len(self.id))})


def encode_both(texts: list[bytes], units: Units) -> tuple[Tokens, Tokens]:
    """The tokens of both sides for the texts that both give back exactly."""
    own: list[str] = []
    many = np.zeros(len(texts), np.int64)
    for i, raw in enumerate(texts):
        if raw:
            parts = _UNIT.split(" " + raw.decode("utf-8", "replace"))
            many[i] = len(parts)
            own += parts
    code = units.codes(own)
    base = np.cumsum([0, *[len(t) + 1 for t in texts]])
    good = many > 0
    good[np.repeat(np.arange(len(texts)), many)[~units.exact[code]]] = False
    sides = tuple(Tokens(units, k, code, many) for k in range(2))
    for t in sides:
        t.keep(good)
        t.move(base)
    return sides


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(token of a, token of b) of every overlapping pair, in order: each start
    finds the other side's covering token, within its document."""
    fa, fb = a.frame("a"), b.frame("b")
    one = pd.merge_asof(fa, fb, on="start", by="doc")
    two = pd.merge_asof(fb, fa, on="start", by="doc")
    # equal starts are found from both directions
    two = two[a.start[two["a"].to_numpy()] != two["start"].to_numpy()]
    x = np.r_[one["a"].to_numpy(), two["a"].to_numpy()]
    y = np.r_[one["b"].to_numpy(), two["b"].to_numpy()]
    order = np.lexsort((y, x))
    return x[order], y[order]


def _digests(a: Tokens, b: Tokens, ends_a: np.ndarray, ends_b: np.ndarray, n_docs: int,
             words: tuple[list[str], list[str], list[str]]) -> list[str]:
    """sha256 of ``a1,a2|b1;a3|b2,b3`` per document; '' without tokens.

    ``words``: each id as text, followed by a comma, a bar, a semicolon."""
    last_a, last_b = (np.zeros(len(t.id), bool) for t in (a, b))
    last_a[ends_a], last_b[ends_b] = True, True
    group = np.r_[np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b]
    n = len(words[0])
    word = np.r_[a.id + n * last_a, b.id + 2 * n * last_b]
    side = np.r_[np.zeros(len(a.id), np.int8), np.ones(len(b.id), np.int8)]
    order = np.lexsort((side, group))  # stable: ids of a side stay in order
    table = np.array([*words[0], *words[1], *words[2]], dtype=object)
    text = table[word[order]]
    cut_at = np.searchsorted(np.r_[a.doc, b.doc][order], np.arange(n_docs + 1))
    out = []
    for i, j in zip(cut_at.tolist(), cut_at[1:].tolist()):
        whole = "".join(text[i:j])[:-1]
        out.append(hashlib.sha256(whole.encode()).hexdigest() if whole else "")
    return out


@lru_cache(maxsize=1)
def _worker(definition: str, model: bytes) -> tuple[Units, tuple[list[str], list[str], list[str]]]:
    """The tokenizers of a worker and all ids as text, with their separators."""
    sides = byte_side(definition), piece_side(model)
    ids = [str(i) for i in range(max(len(s.length) for s in sides))]
    return Units(sides), tuple([i + s for i in ids] for s in ",|;")


_DOCS = ("block bigint, part int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
         "links binary, pairs array<bigint>, counts array<bigint>")
_SCHEMA = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                     ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
                     ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def _align(batch: pa.RecordBatch, worker) -> Iterator[pa.RecordBatch]:
    """The rows of one block: its distinct id pairs (part 0), then its documents
    (part 1) with their links as numbers of those pairs."""
    units, words = worker
    n = batch.num_rows
    ta, tb = encode_both(texts_of(batch, "text"), units)
    x, y = overlaps(ta, tb)
    close = ta.end[x] == tb.end[y]
    x, y = x[close], y[close]
    pairs, number, counts = np.unique(ta.id[x].astype(np.int64) << 32 | tb.id[y], return_inverse=True,
                                      return_counts=True)
    groups = np.bincount(ta.doc[x], minlength=n)
    ends = np.cumsum(groups)
    raw = number.astype("<i4")
    block = batch.column(0)[0].as_py()
    yield pa.RecordBatch.from_pylist([{"block": block, "part": 0, "pairs": pairs.tolist(),
                                       "counts": counts.tolist()}], schema=_SCHEMA)
    yield pa.RecordBatch.from_pydict({
        "block": [block] * n, "part": [1] * n, "doc_id": batch.column(1),
        "n_a": np.bincount(ta.doc, minlength=n), "n_b": np.bincount(tb.doc, minlength=n), "n_groups": groups,
        "groups_sha256": _digests(ta, tb, x, y, n, words),
        "links": [raw[e - g:e].tobytes() for g, e in zip(groups.tolist(), ends.tolist())],
        "pairs": [None] * n, "counts": [None] * n}, schema=_SCHEMA)


def aligned(docs: DataFrame, byte_file: str, piece_file: str, block_bytes: int = 1 << 20) -> DataFrame:
    """The blocks of all rows (see ``_align``); the vocabularies are read by the
    driver and sent to the executors (about three megabytes)."""
    with open(byte_file, encoding="utf-8") as f:
        definition = f.read()
    with open(piece_file, "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((definition, model))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = None
        for batch in slices(batches, "text", block_bytes):
            worker = worker or _worker(*shared.value)
            yield from _align(batch, worker)

    slim = with_types(docs.select(F.monotonically_increasing_id().alias("block"), "doc_id", "text"),
                      doc_id="bigint", text="string")
    return slim.mapInArrow(rows, _DOCS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n, best): links of each id pair over the corpus, and whether no
    other pair of its b id has more."""
    mine = blocks.filter("part = 0").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    total = mine.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")) \
        .withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = total.groupBy("b").agg(F.max("n").alias("most"))
    # one row an id of b: the vocabulary bounds it
    return total.join(F.broadcast(most), "b").select(
        "pair", F.shiftright("pair", 32).alias("a"), "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _read_links(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Per document of one block: links, links to the best partner, summed counts."""
    n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    at = np.asarray(pairs["place"])
    n[at], best[at] = np.asarray(pairs["n"]), np.asarray(pairs["best"]).astype(np.int64)
    links, n_best, count_sum = [], [], []
    for raw in docs["links"].to_pylist():
        k = np.frombuffer(raw, "<i4")
        links.append(len(k))
        n_best.append(int(best[k].sum()))
        count_sum.append(int(n[k].sum()))
    return docs.drop_columns(["block", "links"]).append_column("n_links", pa.array(links, pa.int64())) \
        .append_column("n_best", pa.array(n_best, pa.int64())) \
        .append_column("count_sum", pa.array(count_sum, pa.int64()))


def align(docs: DataFrame, byte_file: str, piece_file: str, block_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum) of
    every row."""
    blocks = cut(aligned(docs, byte_file, piece_file, block_bytes))
    held = blocks.filter("part = 0").select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    read = held.join(pair_counts(blocks).select("pair", "n", "best"), "pair").select("of", "place", "n", "best")
    texts = blocks.filter("part = 1").select("block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
    return texts.groupBy("block").cogroup(read.groupBy("of")).applyInArrow(
        _read_links, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
                     "n_links bigint, n_best bigint, count_sum bigint")
