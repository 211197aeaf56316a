"""Toxicity: misspelled lexicon terms and the windows around them.

1. The lexicon is learned from labelled rows: words whose document counts
   differ between toxic and other rows beyond chance (log-likelihood ratio).
2. Levenshtein automata of all terms are run as one automaton on the lexicon
   trie: a state is a set of (trie node, edits); states are made on demand and
   kept.  A text word is matched by following it, so a misspelled term is
   caught without comparing the word with every term.  Words are also split at
   punctuation inside, signs that look like letters are read as these, and the
   labelled rows say what the misspelt forms of each term are worth: forms as
   common in other texts count nothing.
3. Every hit has a window of ``WINDOW`` words on each side.  Cue weights of the
   window's words, learned from hits in toxic and in other rows, and quotation
   marks tell a quotation from abuse.  Cues are the words whose rates among
   toxic and other texts with a hit differ beyond chance, however many.
4. A logistic regression over the document's hit and window figures gives the
   score.

The fit uses at most ``max_train`` labelled texts (documented bound), equal texts
with the same label once.  Counts are taken on executors; the driver sees the
terms, the cues and the figures only.

Edge cases: a null text is empty and gets the score of a text without hits;
null labels and ids take no part in the fit; without labels of both kinds every
score is the base rate; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import cut, slices, texts_of
from plume.llm.quality_gam import labelled, scored

WINDOW = 4
LEAST_CUE = 10.83  # log-likelihood ratio of a chance of one in a thousand
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’¿¡…"
_QUOTES = set("\"'«»“”„‘’")
_INNER = re.compile(r"[^\w\s]+|_+")
#: signs read as letters (fixed values)
_LETTER = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_ALIKE = set("013457@$")
RARE = 3.0        # documents' worth of belief in the term's own weight
LEAST_FORM = 0.3  # a misspelt form of less weight is no hit


def bare(word: str) -> str:
    return word.strip(_EDGE)


def words_of(text: bytes) -> list[str]:
    """The lower-case words of a text; a word with punctuation inside, and no
    letter or digit missing there, is followed by its parts."""
    out = []
    for w in text.decode("utf-8", "replace").lower().split():
        out.append(w)
        if not w.isalnum():  # most words have nothing to split
            inner = bare(w)
            if not inner.isalnum():
                parts = _INNER.split(inner)
                if len(parts) > 1:
                    out += [p for p in parts if p]
    return out


def edits_allowed(term: str) -> int:
    """One edit from four letters on, two from nine on; shorter terms exactly."""
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class FuzzyLexicon:
    """Levenshtein automata of all terms, intersected with their trie.

    An edit is a letter more, less or other, or two neighbours swapped.
    """

    def __init__(self, terms: list[str]):
        self.terms = sorted(set(terms))
        self.child: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.most: list[int] = [0]  # largest budget of a term below the node
        for i, t in enumerate(self.terms):
            node, budget = 0, edits_allowed(t)
            self.most[0] = max(self.most[0], budget)
            for c in t:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.term.append(-1)
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], budget)
            self.term[node] = i
        self._ids: dict[tuple, int] = {}
        self._sets: list[dict[tuple[int, str], int]] = []
        self._next: list[dict[str, int]] = []
        self._hit: list[tuple[int, int]] = []
        self.start = self._state({(0, ""): 0})

    def _state(self, raw: dict[tuple[int, str], int]) -> int:
        """State id of the closure under skipped term letters; -1 if empty.

        A place is (trie node, ""), or (node, letter) after the first half of a
        swap: only that letter leads on, to the node.
        """
        least = dict(raw)
        todo = [node for node, due in raw if not due]
        while todo:
            node = todo.pop()
            e = least[node, ""] + 1
            for kid in self.child[node].values():
                if e <= self.most[kid] and e < least.get((kid, ""), 99):
                    least[kid, ""] = e
                    todo.append(kid)
        if not least:
            return -1
        key = tuple(sorted(least.items()))
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(least)
            self._next.append({})
            hits = [(e, self.term[n]) for (n, due), e in least.items() if not due
                    and self.term[n] >= 0 and e <= edits_allowed(self.terms[self.term[n]])]
            self._hit.append(min(hits, default=(-1, -1)))
        return self._ids[key]

    def _step(self, state: int, c: str) -> int:
        raw: dict[tuple[int, str], int] = {}

        def reach(node: int, due: str, e: int) -> None:
            if e <= self.most[node] and e < raw.get((node, due), 99):
                raw[node, due] = e

        for (node, due), e in self._sets[state].items():
            if due:
                if c == due:
                    reach(node, "", e)
                continue
            reach(node, "", e + 1)  # c is an extra letter
            for x, kid in self.child[node].items():
                reach(kid, "", e + (x != c))
                if x != c and c in self.child[kid]:
                    reach(self.child[kid][c], x, e + 1)  # x is due after c
        self._next[state][c] = out = self._state(raw)
        return out

    def match(self, word: str) -> tuple[int, int]:
        """(term index, edits) of the nearest term within its budget, ties to
        the smaller term; (-1, -1) if there is none."""
        state = self.start
        for c in word:
            nxt = self._next[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state < 0:
                return -1, -1
        e, term = self._hit[state]
        return term, e

    def find(self, word: str) -> tuple[int, int]:
        """``match`` of a word as it stands in a text; a word that mixes letters
        and look-alike signs is read as letters, which counts as one edit."""
        word = bare(word)
        term, e = self.match(word)
        if term < 0 and not _ALIKE.isdisjoint(word) and any(c.isalpha() for c in word):
            term, e = self.match(word.translate(_LETTER))
            e = max(e, 1) if term >= 0 else e
        return term, e


@dataclass
class ToxicModel:
    """``weights``: log rate ratio of each term; ``misspelt``: the same for its
    forms at one edit, two edits, where the sample says more than chance."""

    terms: list[str]
    weights: list[float]
    misspelt: dict[tuple[int, int], float] = field(default_factory=dict)
    cues: dict[str, float] = field(default_factory=dict)
    beta: np.ndarray = field(default_factory=lambda: np.zeros(9))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(8))
    scale: np.ndarray = field(default_factory=lambda: np.ones(8))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_matcher"}

    def weight(self, term: int, edits: int) -> float:
        return self.misspelt.get((term, edits), self.weights[term] / (1 + edits)) if edits else self.weights[term]

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(place, term, edits) of each hit among a text's words; misspelt forms
        that the sample gives no weight are none."""
        if "_matcher" not in self.__dict__:  # made once in a worker
            self._matcher = FuzzyLexicon(self.terms), {}
        lexicon, seen = self._matcher
        if len(seen) > 300_000:  # a memory bound only: matches are found again
            seen.clear()
        out = []
        for i, w in enumerate(words):
            got = seen.get(w)
            if got is None:
                got = seen[w] = lexicon.find(w)
            if got[0] >= 0 and (not got[1] or self.misspelt.get(got, 1.0) > 0):
                out.append((i, *got))
        return out

    def figures(self, text: bytes) -> list[float]:
        """Hit and window figures of one whole text."""
        words = words_of(text)
        exact = fuzzy = quoted = near = 0
        weight = best = context = 0.0
        last = -10 ** 9
        for i, t, e in self.hits(words):
            exact, fuzzy = exact + (e == 0), fuzzy + (e > 0)
            w = self.weight(t, e)
            around = [bare(x) for x in words[max(0, i - WINDOW):i] + words[i + 1:i + 1 + WINDOW]]
            c = sum(self.cues.get(x, 0.0) for x in around)
            quoted += words[i][0] in _QUOTES or words[i][-1] in _QUOTES
            near += i - last <= WINDOW
            weight, context, best, last = weight + w, context + c, max(best, w + c), i
        n = max(1, len(words))
        return [np.log1p(exact), np.log1p(fuzzy), np.log1p(weight), best,
                context / max(1, exact + fuzzy), np.log1p(1000 * exact / n),
                quoted / max(1, exact + fuzzy), np.log1p(near)]

    def score(self, texts: list[bytes]) -> np.ndarray:
        x = np.array([self.figures(t) for t in texts], dtype=float).reshape(-1, 8)
        z = self.beta[0] + ((x - self.mean) / self.scale) @ self.beta[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is free."""
    beta = np.zeros(x.shape[1])
    pen = np.full(x.shape[1], ridge)
    pen[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pen),
                               x.T @ (y - p) - pen * beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def _counts(rows: DataFrame, words_of) -> DataFrame:
    """(word, toxic, other): documents whose ``words_of(text)`` holds the word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            got: dict[str, list[int]] = {}
            for t, y in zip(texts_of(b, "text"), b.column(b.schema.get_field_index("label")).to_pylist()):
                for w in words_of(t):
                    got.setdefault(w, [0, 0])[0 if y else 1] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(got), pa.string()), *[pa.array([v[k] for v in got.values()], pa.int64())
                                                     for k in (0, 1)]], ["word", "toxic", "other"])

    return rows.select("text", "label").mapInArrow(count, "word string, toxic bigint, other bigint") \
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _ratio(a, b, n1: float, n0: float):
    """Log-likelihood ratio of a word's document counts (``a`` of ``n1`` toxic,
    ``b`` of ``n0`` other documents) against equal rates."""
    rate = (a + b) / F.lit(float(n1 + n0))

    def cell(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    return 2 * (cell(a, n1 * rate) + cell(b, n0 * rate)
                + cell(n1 - a, n1 * (1 - rate)) + cell(n0 - b, n0 * (1 - rate)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = 20_000,
          least_ratio: float = 30.0, least_cue_ratio: float = LEAST_CUE) -> ToxicModel:
    """Learn lexicon, cues and weights from labelled rows (see module text)."""
    # read four times, bounded by max_train; a group of copies counts as one text
    rows = cut(labelled(docs, labels, label, max_train).select("text", "label"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    base = np.log((n1 + 0.5) / (n0 + 0.5))
    if not n1 or not n0:
        return ToxicModel([], [], beta=np.r_[base, np.zeros(8)])

    terms = _counts(rows, lambda t: {bare(w) for w in words_of(t)} - {""}) \
        .filter(2 * F.col("toxic") * n0 > 3 * F.col("other") * n1) \
        .withColumn("ratio", _ratio(F.col("toxic"), F.col("other"), n1, n0)).filter(F.col("ratio") >= least_ratio).collect()
    model = ToxicModel([r["word"] for r in terms], [])
    weight = {r["word"]: float(np.log((r["toxic"] + 0.5) / n1 / ((r["other"] + 0.5) / n0))) for r in terms}
    model.terms = sorted(weight)
    model.weights = [weight[t] for t in model.terms]

    def forms_of(t: bytes, m: ToxicModel = model) -> set[str]:
        """The misspelt terms of a text, as ``term number, edits``."""
        return {f"{term} {e}" for _, term, e in m.hits(words_of(t)) if e}

    # a form's own rates, drawn to a share of its term's weight while it is rare
    misspelt = {}
    for r in cut(_counts(rows, forms_of)).collect():  # two rows a term at most
        term, e = map(int, r["word"].split())
        seen = r["toxic"] + r["other"]
        own = np.log((r["toxic"] + 0.5) / n1 / ((r["other"] + 0.5) / n0))
        got = (seen * own + RARE * model.weights[term] / (1 + e)) / (seen + RARE)
        misspelt[term, e] = float(got) if got > LEAST_FORM else 0.0
    model.misspelt = dict(sorted(misspelt.items()))
    model.__dict__.pop("_matcher", None)

    def cues_of(t: bytes, m: ToxicModel = model) -> set[str]:
        """Words around the hits, and "" for a text with a hit."""
        words = words_of(t)
        hits = m.hits(words)
        return {bare(x) for i, _, _ in hits
                for x in words[max(0, i - WINDOW):i] + words[i + 1:i + 1 + WINDOW]} | ({""} if hits else set())

    near = cut(_counts(rows, cues_of))
    hit1, hit0 = next(((r["toxic"], r["other"]) for r in near.filter("word = ''").collect()), (0, 0))
    if hit1 and hit0:
        share1, share0 = hit1 / (hit1 + hit0), hit0 / (hit1 + hit0)
        cues = near.filter("word != ''") \
            .withColumn("ratio", _ratio(F.col("toxic"), F.col("other"), hit1, hit0)) \
            .filter(F.col("ratio") >= least_cue_ratio).collect()
        model.cues = {r["word"]: float(np.log((r["toxic"] + 5 * share1) / hit1 / ((r["other"] + 5 * share0) / hit0)))
                      for r in sorted(cues, key=lambda r: r["word"])}

    def figures(batches: Iterator[pa.RecordBatch], m: ToxicModel = model) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            x = np.array([m.figures(t) for t in texts_of(b, "text")], dtype=float).reshape(-1, 8)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("label")), *[pa.array(c) for c in x.T]],
                ["label", *[f"x{k}" for k in range(8)]])

    got = rows.select("text", "label").mapInArrow(
        figures, "label int, " + ", ".join(f"x{k} double" for k in range(8))).toArrow()
    x = np.column_stack([np.asarray(got[f"x{k}"]) for k in range(8)])
    y = np.asarray(got["label"]).astype(float)
    order = np.lexsort((*x.T, y))  # sums do not depend on the order of arrival
    x, y = x[order], y[order]
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    model.scale[x.std(0) == 0] = 1.0
    model.beta = _logistic(np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale]), y)
    return model


def score(docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` for every row, over whole texts."""
    return scored(docs, model.score, keep)
