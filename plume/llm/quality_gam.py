"""Quality classifier: a generalised additive model with pair interactions.

Text features are binned; cyclic gradient boosting of shallow trees (one split
per step on one feature, one split per axis on a feature pair) adds up to one
lookup table per feature and one per chosen pair.  A score is the logistic of
the sum of table entries, so scoring is a few vectorised gathers per batch.

Features are computed on executors over whole texts.  The fit runs on the
driver over at most ``max_train`` distinct labelled texts (a documented bound;
see ``labelled``), i.e. ``max_train`` x 17 numbers; a text under several ids
weighs as many.

Edge cases: a null text counts as empty and gets a score like any other; a
null label or id takes no part in the fit; repeated labels and rows count once;
without labels of both kinds the model is the constant base rate (0.5 without
any label); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import slices, texts_of, with_types

FEATURES = ("log_words", "word_length", "upper_share", "digit_share", "space_share",
            "mark_share", "stop_share", "bar_share", "other_share", "word_variety",
            "next_same", "line_variety", "log_line_words", "marked_word_ends", "top_word_share",
            "tail_variety")

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_HIGH = bytes(range(128, 256))
_STOPS = b".,"
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,|")


def features_of(text: bytes) -> list[float]:
    """The feature row of one whole text."""
    n = max(1, len(text))

    def share(chars: bytes) -> float:
        return (len(text) - len(text.translate(None, chars))) / n

    words = text.split()
    w = max(1, len(words))
    distinct: dict[bytes, int] = {}
    for x in words:
        distinct[x] = distinct.get(x, 0) + 1
    lines = [x for x in text.split(b"\n") if x]
    half = words[len(words) // 2:]
    upper = share(_UPPER)
    return [
        np.log1p(len(words)), len(text) / w, upper, share(_DIGIT), share(_SPACE), share(_MARKS),
        share(_STOPS), share(b"|"), 1 - upper - share(_LOWER) - share(_HIGH), len(distinct) / w,
        sum(a == b for a, b in pairwise(words)) / w,
        len(set(lines)) / max(1, len(lines)), np.log1p(w / max(1, len(lines))),
        sum(x[-1] in _MARKS for x in words) / w,
        max(distinct.values(), default=0) / w, len(set(half)) / max(1, len(half)),
    ]


def feature_matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([features_of(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class Gam:
    """Bin edges per feature, lookup tables per feature and per pair."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        out = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            out += table[bins[j]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            out += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def _best_split(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[int, float, float]:
    """Cut of a binned axis with the largest gain; the Newton value each side."""
    g, h = np.cumsum(grad), np.cumsum(hess)
    left, right = g[:-1] ** 2 / (h[:-1] + ridge), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
    k = int(np.argmax(left + right))
    return k, g[k] / (h[k] + ridge), (g[-1] - g[k]) / (h[-1] - h[k] + ridge)


def fit_gam(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, bins: int = 48, rounds: int = 150, rate: float = 0.15,
            n_pairs: int = 8, pair_bins: int = 8, pair_rounds: int = 60,
            ridge: float = 5.0) -> Gam:
    """Cyclic boosting: round after round, every feature in turn gets one small
    tree on the current residual; then the strongest pairs do the same.  A row
    of weight w counts like w rows."""
    n = len(y)
    w = np.ones(n) if weight is None else weight
    rate0 = ((w * y).sum() + 0.5) / (w.sum() + 1)
    k = x.shape[1]
    if n == 0 or y.min() == y.max():
        return Gam(float(np.log(rate0 / (1 - rate0))), [np.empty(0)] * k, [np.zeros(1)] * k)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], weights=w, method="inverted_cdf"))
             for j in range(k)]
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Gam(float(np.log(rate0 / (1 - rate0))), edges, tables)
    f = np.full(n, model.intercept)
    for _ in range(rounds):
        for j in range(k):
            if len(tables[j]) < 2:
                continue
            p = 1 / (1 + np.exp(-f))
            cut, lo, hi = _best_split(np.bincount(at[j], w * (y - p), len(tables[j])),
                                      np.bincount(at[j], w * p * (1 - p), len(tables[j])), ridge)
            step = np.where(np.arange(len(tables[j])) <= cut, lo, hi) * rate
            tables[j] += step
            f += step[at[j]]
    model.coarse = [(np.arange(len(t)) * pair_bins // len(t)) for t in tables]
    grid = [c[a] for c, a in zip(model.coarse, at)]

    def sums(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(grid[i] * pair_bins + grid[j], v, pair_bins ** 2) \
            .reshape(pair_bins, pair_bins)

    p = 1 / (1 + np.exp(-f))
    gain = {(i, j): float((sums(i, j, w * (y - p)) ** 2 / (sums(i, j, w * p * (1 - p)) + ridge)).sum())
            for i in range(k) for j in range(i + 1, k)}
    model.pairs = sorted(sorted(gain, key=gain.get)[::-1][:n_pairs])
    model.pair_tables = [np.zeros((pair_bins, pair_bins)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            p = 1 / (1 + np.exp(-f))
            g, h = sums(i, j, w * (y - p)), sums(i, j, w * p * (1 - p))
            a, b = _best_split(g.sum(1), h.sum(1), ridge)[0], _best_split(g.sum(0), h.sum(0), ridge)[0]
            step = np.zeros_like(table)
            for rows in (slice(0, a + 1), slice(a + 1, None)):
                for cols in (slice(0, b + 1), slice(b + 1, None)):
                    step[rows, cols] = rate * g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
            table += step
            f += step[grid[i], grid[j]]
    return model


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_train: int) -> DataFrame:
    """(text, label, copies): distinct labelled texts, at most ``max_train``.

    Labels are bounded first, chosen by a hash of the id, then the texts they
    bring, by a hash of the text: an id that stands on many rows cannot add more.
    ``copies`` counts the ids a text stands under, each once however often its
    row is repeated.
    """
    chosen = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()) \
        .select("doc_id", F.col(label).cast("int").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_train)
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), "doc_id")  # max_train rows
    ids = found.groupBy("text", "label", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    return ids.groupBy("text", "label").agg(F.count(F.lit(1)).alias("copies")) \
        .orderBy(F.xxhash64("text"), "text", "label").limit(max_train)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality",
          max_train: int = 20_000) -> Gam:
    """Fit on the labelled rows of ``labels`` (doc_id, ``label``)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            m = feature_matrix(texts_of(b, "text"))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(c)) for c in ("label", "copies")],
                 *[pa.array(c) for c in m.T]], ["label", "copies", *FEATURES])

    names = ", ".join(f"{c} double" for c in FEATURES)
    got = labelled(docs, labels, label, max_train).mapInArrow(
        rows, f"label int, copies bigint, {names}").toArrow()
    x = np.column_stack([np.asarray(got[c]) for c in FEATURES]).reshape(-1, len(FEATURES))
    y = np.asarray(got["label"]).astype(float)
    weight = np.asarray(got["copies"]).astype(float)
    order = np.lexsort((weight, *x.T, y))  # the fit does not depend on the order of arrival
    return fit_gam(x[order], y[order], weight[order])


def score(docs: DataFrame, model: Gam, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` for every row, over whole texts."""
    return scored(docs, lambda texts: model.score(feature_matrix(texts)), keep)


def scored(docs: DataFrame, of: Callable[[list[bytes]], np.ndarray],
           keep: tuple[str, ...]) -> DataFrame:
    """Append ``score`` = ``of(texts)`` to the ``keep`` columns, in one pass."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text_"):
            s = of(texts_of(b, "text_"))
            cols = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.asarray(s, dtype=np.float64))],
                                             [*keep, "score"])

    slim = with_types(docs.select(*keep, F.col("text").alias("text_")), text_="string")
    schema = slim.drop("text_").withColumn("score", F.lit(0.0)).schema
    return slim.mapInArrow(rows, schema)
