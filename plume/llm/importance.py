"""Importance resampling of documents towards a target text distribution.

Features are hashed runs of one to three words.  Bucket counts over all
documents and over all target texts give every bucket a gain (the floored log of
its smoothed share in the target over its share in the corpus); the gains are
one array, by which a task scores its batches: hashes of all runs of a batch are
array operations, because the CRC of two joined strings follows from their two
CRCs and the second's length.  A document's score is its summed gain plus
Gumbel noise drawn from its id, so taking the highest scores is a draw without
replacement in proportion to the weights.  The order of the scores comes from a
distributed radix sort (``radix``).

Only rows whose leading score digit reaches the one in which the last drawn row
lies enter the sort; the others cannot be drawn.

Edge cases: null and empty texts have no features and weight 0; a null doc_id
draws its noise as an empty id and comes after all others in ties; repeated
rows are drawn separately; an empty table gives an empty result; an empty target
gives every bucket the gain of an unseen one; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.llm.common import cut, slices, texts_of, with_types
from plume.llm.radix import Key, positions

BUCKETS = 10_000
LONGEST = 3
_LEAD = 1 << 12

#: words are runs of ASCII letters and digits and of all non-ASCII bytes
_TO_WORDS = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32
                  for c in range(256))


class _Crc:
    """CRC-32 of joined strings from the CRCs of the parts, on arrays.

    Appending n bytes to a string multiplies its CRC by a matrix over bits;
    ``short[n]`` and ``power[k]`` (n = 2^k) hold its four byte-wise tables.
    """

    SHORT = 64

    def __init__(self):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = (step >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (step & np.uint32(1)))
        table = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])
        short = [table]
        for _ in range(self.SHORT):
            table = step[table & np.uint32(255)] ^ (table >> np.uint32(8))
            short.append(table)
        self.power = [short[self.SHORT]]
        self.short = np.stack(short[:self.SHORT])

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return (table[0][crc & np.uint32(255)] ^ table[1][(crc >> np.uint32(8)) & np.uint32(255)]
                ^ table[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ table[3][crc >> np.uint32(24)])

    def shift(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """CRCs after ``size`` more zero bytes."""
        low = size % self.SHORT
        b = np.uint32(255)
        out = (self.short[low, 0, crc & b] ^ self.short[low, 1, (crc >> np.uint32(8)) & b]
               ^ self.short[low, 2, (crc >> np.uint32(16)) & b] ^ self.short[low, 3, crc >> np.uint32(24)])
        high, k = size // self.SHORT, 0
        while high.any():
            if k == len(self.power):
                self.power.append(self._apply(self.power[-1], self.power[-1]))
            odd = np.flatnonzero(high & 1)
            out[odd] = self._apply(self.power[k], out[odd])
            high, k = high >> 1, k + 1
        return out


@lru_cache(maxsize=1)
def _crc() -> _Crc:
    return _Crc()


def features(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text number) of every run of words, and the words per text."""
    words: list[bytes] = []
    many = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        own = t.translate(_TO_WORDS).split()
        many[i] = len(own)
        words += own
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), many
    code, distinct = pd.factorize(np.array(words, dtype=object))
    del words
    first = np.fromiter((zlib.crc32(w) for w in distinct), np.uint32, len(distinct))
    later = np.fromiter((zlib.crc32(b" " + w) for w in distinct), np.uint32, len(distinct))[code]
    size = np.fromiter((len(w) + 1 for w in distinct), np.int64, len(distinct))[code]
    text = np.repeat(np.arange(len(texts)), many)
    run = first[code]
    found, where = [run], [text]
    for n in range(1, min(LONGEST, len(code))):
        run = _crc().shift(run[:-1], size[n:]) ^ later[n:]
        inside = text[n:] == text[:-n]
        found.append(run[inside])
        where.append(text[n:][inside])
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), np.concatenate(where), many


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of ``text``: a task adds up its own batches."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in slices(batches, "text"):
            n += np.bincount(features(texts_of(b, "text"), buckets)[0], minlength=buckets)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], ["bucket", "n"])

    slim = with_types(texts.select("text"), text="string")
    return slim.mapInArrow(rows, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _array(counts: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for r in counts.collect():  # at most a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the corpus)), smoothed by one."""
    n = len(corpus)
    s_all, t_all = float(sum(corpus) + n), float(sum(target) + n)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(corpus, target)], np.int64)


def noise(doc_id: Column, seed: int = 42) -> Column:
    """floor(1000 g) of a standard Gumbel draw g from the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``."""
    table = gains(_array(bucket_counts(docs, buckets), buckets), _array(bucket_counts(target, buckets), buckets))
    shared = docs.sparkSession.sparkContext.broadcast(table)  # a number a bucket

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in slices(batches, "text"):
            bucket, text, words = features(texts_of(b, "text"), buckets)
            total = np.bincount(text, gain[bucket], b.num_rows)  # whole numbers, exact in doubles
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words), pa.array(np.bincount(text, minlength=b.num_rows)),
                 pa.array(total.astype(np.int64))], ["doc_id", "n_words", "n_features", "weight"])

    slim = with_types(docs.select("doc_id", "text"), doc_id="bigint", text="string")
    out = slim.mapInArrow(rows, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return out.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _least_lead(able: DataFrame, draws: int) -> int:
    """The lowest score of the leading digit value that holds the last drawn row."""
    low, high = able.agg(F.min("score"), F.max("score")).first()
    width = max(1, -(-(high - low + 1) // _LEAD))
    lead = F.floor((F.col("score") - F.lit(low)) / F.lit(width))
    taken = 0
    for r in able.groupBy(lead.alias("lead")).count().orderBy(F.desc("lead")).collect():
        taken += r["count"]
        if taken >= draws:
            return low + r["lead"] * width
    return low


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, at_least: int = 20,
             buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row.

    ``percent`` of the documents with ``at_least`` words are drawn; ``rank``
    counts from 1 by falling score, ties to the smaller doc_id, and is null for
    documents that are not drawn.
    """
    rows = cut(scored(docs, target, buckets, seed))
    able = rows.filter(F.col("n_words") >= at_least)
    draws = percent * able.count() // 100
    if not draws:
        return rows.withColumn("rank", F.lit(None).cast("bigint"))
    enters = (F.col("n_words") >= at_least) & (F.col("score") >= F.lit(_least_lead(able, draws)))
    inside = rows.filter(enters).withColumn("_no_id", F.col("doc_id").isNull().cast("bigint")) \
        .withColumn("_id", F.coalesce("doc_id", F.lit(0)).cast("bigint"))
    # equal ids have equal noise: of these the longer comes first, other ties are equal rows
    placed = positions(inside, [Key("score", True), Key("_no_id"), Key("_id"), Key("n_features", True)],
                       "_rank")
    drawn = placed.drop("_no_id", "_id") \
        .withColumn("rank", F.when(F.col("_rank") < draws, F.col("_rank") + 1)).drop("_rank")
    return drawn.unionByName(rows.filter(~enters).withColumn("rank", F.lit(None).cast("bigint")))
