"""Token counts by a linear longest-match automaton.

Greedy longest-match-first word pieces are counted without building them.  The
vocabulary is a trie over bytes plus one end-of-word symbol.  Every node has a
failure link (where to go on when the next symbol has no edge) and the number
of pieces popped on the way there, both precomputed; so a word costs as many
steps as it has symbols, plus one step for each piece.

Words are lower-cased and split as the vocabulary's own tokenizer does (letter
runs, single digits, runs of other marks, English contractions).  A batch's
distinct white-space words are counted once, all of them side by side.

Edge cases: null and empty texts have no tokens; every byte is a piece, so any
text can be counted; a plain piece may stand at a word's end if the rest of the
word has no piece with an end mark (the mark alone costs nothing); repeated
rows are counted each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from plume.llm.common import slices, texts_of, with_types
from plume.llm.trie import ByteTrie

END = 256
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for bytes:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + i)] = b
    return out


def load_vocabulary(path: str) -> list[tuple[int, ...]]:
    """Pieces as symbol tuples from a byte-level vocabulary file with word ends."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"] for t in data.get("added_tokens", [])}
    letters = byte_letters()
    pieces = []
    for token in sorted(data["model"]["vocab"]):
        if token in special:
            continue
        body, end = (token[:-4], (END,)) if token.endswith("</w>") else (token, ())
        pieces.append((*[letters[c] for c in body], *end))
    return pieces


class LongestMatch:
    """Trie, failure links and popped-piece counts."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        known = {p for p in pieces if p}
        every = sorted(known | {(b,) for b in range(256)} | {(END,)})
        trie = ByteTrie([(p, i) for i, p in enumerate(every)], symbols=257)
        n = len(trie.parent)
        cost = np.ones(len(every), np.int32)
        if (END,) not in known:
            cost[every.index((END,))] = 0
        self.next = trie.next
        self.fail = np.zeros(n, np.int32)
        self.popped = np.zeros(n, np.int32)
        nxt, fail, popped = trie.next, self.fail, self.popped
        for v in np.argsort(trie.depth, kind="stable")[1:].tolist():
            if trie.entry[v] >= 0:  # the path is a piece itself: pop it, go on at the root
                popped[v] = cost[trie.entry[v]]
                continue
            u, c = int(trie.parent[v]), int(trie.label[v])
            total, z = int(popped[u]), int(fail[u])
            while not nxt[z, c]:  # ends at the root: it has an edge for every symbol
                total, z = total + int(popped[z]), int(fail[z])
            fail[v], popped[v] = nxt[z, c], total
        self.rest = np.zeros(n, np.int32)  # pieces popped from a node down to the root
        for v in np.argsort(trie.depth, kind="stable")[1:].tolist():
            self.rest[v] = popped[v] + self.rest[fail[v]]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word, an end mark being added to each."""
        n = len(words)
        size = np.fromiter((len(w) for w in words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int16)
        start = np.cumsum(size) - size
        out = np.zeros(n, np.int64)
        live, node, at = np.arange(n), np.zeros(n, np.int32), np.zeros(n, np.int64)
        while len(live):
            c = np.full(len(live), END, np.int16)
            inner = at < size[live]
            c[inner] = flat[start[live[inner]] + at[inner]]
            to = self.next[node, c]
            stuck = to == 0
            out[live[stuck]] += self.popped[node[stuck]]
            node = np.where(stuck, self.fail[node], to)
            at += ~stuck
            over = at > size[live]
            out[live[over]] += self.rest[node[over]]
            live, node, at = live[~over], node[~over], at[~over]
        return out


def words_of(chunk: str) -> list[bytes]:
    """The words of a piece of text without white space."""
    return [w.encode("utf-8", "surrogatepass") for w in _WORDS.findall(chunk.lower())]


@lru_cache(maxsize=1)
def _automaton(pieces: tuple[tuple[int, ...], ...]) -> LongestMatch:
    return LongestMatch(list(pieces))


def count_texts(texts: list[bytes], auto: LongestMatch) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, words) per text; each distinct chunk is walked once."""
    chunks = [t.decode("utf-8", "replace").split() for t in texts]
    many = np.fromiter((len(c) for c in chunks), np.int64, len(chunks))
    code, distinct = pd.factorize(np.array([c for cs in chunks for c in cs] or [""], dtype=object)[:many.sum()])
    parts = [words_of(c) for c in distinct]
    inner = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    per_word = auto.counts([w for p in parts for w in p])
    ends = np.r_[0, np.cumsum(inner)]
    sums = np.r_[0, np.cumsum(per_word)]
    per_chunk = sums[ends[1:]] - sums[ends[:-1]]
    of_text = np.repeat(np.arange(len(texts)), many)

    def total(v: np.ndarray) -> np.ndarray:
        return np.bincount(of_text, v[code], len(texts)).astype(np.int64)

    if not len(code):
        return np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    return total(per_chunk), total(inner)


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, n_words, n_bytes) for every row.  The vocabulary file
    is read by the driver; its pieces (about a megabyte) go to the executors."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(load_vocabulary(vocabulary)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(shared.value)
        for b in slices(batches, "text"):
            texts = texts_of(b, "text")
            tokens, words = count_texts(texts, auto)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(tokens), pa.array(words),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["doc_id", "n_tokens", "n_words", "n_bytes"])

    slim = with_types(docs.select("doc_id", "text"), doc_id="bigint", text="string")
    return slim.mapInArrow(rows, "doc_id bigint, n_tokens bigint, n_words bigint, n_bytes bigint")
