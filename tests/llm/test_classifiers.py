import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plume.llm import quality_gam, toxicity
from plume.llm.queries import op5_toxicity, op10_quality_classifier

SF = "/root/testdata/sf0.01"
TERMS = ["idiot", "idol", "worthless", "scum", "disgusting", "disgust", "clown"]
LEX = toxicity.FuzzyLexicon(TERMS)


def _edits(a, b):
    """Letters more, less or other, and neighbours swapped."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def _nearest(word):
    near = [(_edits(word, t), i) for i, t in enumerate(LEX.terms) if _edits(word, t) <= toxicity.edits_allowed(t)]
    return min(near, default=(-1, -1))[::-1]


@settings(deadline=None, max_examples=300)
@given(st.one_of(st.text(alphabet="idotclwnscumx", max_size=12),
                 st.tuples(st.sampled_from(TERMS), st.integers(0, 12), st.text(alphabet="aeixs1", max_size=2),
                           st.integers(0, 3)).map(lambda t: t[0][:t[1]] + t[2] + t[0][t[1] + t[3]:])))
def test_levenshtein_automaton_against_distances(word):
    assert LEX.match(word) == _nearest(word)


@pytest.mark.parametrize("word, term, edits", [
    ("scun", "scum", 1), ("scmu", "scum", 1), ("idoit", "idiot", 1), ("id1ot", "idiot", 1), ("1d10t", "idiot", 1),
    ("\"scum!\"", "scum", 0), ("sum", "scum", 1), ("worthles", "worthless", 1), ("wrothlses", "worthless", 2)])
def test_misspellings_are_found(word, term, edits):
    got, e = LEX.find(word)
    assert (LEX.terms[got], e) == (term, edits)


def test_words_split_at_inner_punctuation():
    assert toxicity.words_of("You moron/idiot, ok... a_b".encode()) == [
        "you", "moron/idiot,", "moron", "idiot", "ok...", "a_b", "a", "b"]


def test_forms_as_common_elsewhere_are_no_hits(spark):
    rows = [(f"you garbage person n{i}" if i % 2 else f"a garbagge collector n{i}", i % 2) for i in range(200)]
    rows += [(f"such garbaje n{i}", 1) for i in range(40)]
    model = _trained(spark, rows)
    t = model.terms.index("garbage")
    assert [e for _, x, e in model.hits(["garbagge", "garbaje", "garbage"]) if x == t][-1] == 0
    assert model.weight(t, 1) < model.weights[t]
    rows = [(f"you garbage person n{i}" if i % 2 else f"a garbagge collector n{i}", i % 2) for i in range(200)]
    assert _trained(spark, rows).hits(["garbagge"]) == []


def _naive_toxic(model, text):
    """Figures and score of one text, every word compared with every term."""
    import math
    import re
    words = []
    for w in (text or "").lower().split():
        words += [w, *([p for p in re.split(r"[^\w\s]+|_+", toxicity.bare(w)) if p]
                       if re.search(r"[^\w\s]|_", toxicity.bare(w)) else [])]

    def nearest(word):
        near = [(_edits(word, t), i) for i, t in enumerate(model.terms)
                if abs(len(word) - len(t)) <= 2 and _edits(word, t) <= toxicity.edits_allowed(t)]
        return min(near, default=None)

    known = {}
    for w in set(words):
        b = toxicity.bare(w)
        got = nearest(b)
        if got is None and any(c in "013457@$" for c in b) and any(c.isalpha() for c in b):
            got = nearest(b.translate(str.maketrans("013457@$", "oieastas")))
            got = got and (max(1, got[0]), got[1])
        if got and got[0] and model.misspelt.get((got[1], got[0]), 1.0) <= 0:
            got = None
        known[w] = got
    exact = fuzzy = quoted = near = 0
    weight = best = context = 0.0
    last = None
    for i, w in enumerate(words):
        if known[w] is None:
            continue
        e, t = known[w]
        worth = model.weights[t] if not e else model.misspelt.get((t, e), model.weights[t] / (1 + e))
        cue = sum(model.cues.get(toxicity.bare(words[j]), 0.0) for j in range(max(0, i - 4), min(len(words), i + 5)) if j != i)
        exact, fuzzy = exact + (e == 0), fuzzy + (e > 0)
        quoted += w[0] in "\"'«»“”„‘’" or w[-1] in "\"'«»“”„‘’"
        near += last is not None and i - last <= 4
        weight, context, best, last = weight + worth, context + cue, max(best, worth + cue), i
    hits = max(1, exact + fuzzy)
    x = [math.log1p(exact), math.log1p(fuzzy), math.log1p(weight), best, context / hits,
         math.log1p(1000 * exact / max(1, len(words))), quoted / hits, math.log1p(near)]
    z = model.beta[0] + sum(b * (v - m) / s for b, v, m, s in zip(model.beta[1:], x, model.mean, model.scale))
    return 1 / (1 + math.exp(-max(-40, min(40, z))))


def test_toxicity_scores_against_a_naive_version(spark):
    """Every text of the small table, and the edge texts."""
    from plume.llm.queries import TOXIC_FOLD, train_labels
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), train_labels(spark, SF, TOXIC_FOLD))
    assert model.terms
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(-1, None), (-2, ""), (-3, "scum/idiot \"moron\" m0r0n")]
    got = {r["doc_id"]: r["score"] for r in
           toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    for d, t in rows:
        assert got[d] == pytest.approx(_naive_toxic(model, t), abs=1e-9)


def _naive_gam(x, y, w, rounds, rate, ridge, bins):
    """Main effects by plain loops: all cuts of all features tried one by one."""
    import math
    k, n = len(x[0]), len(y)
    base = math.log((sum(a * b for a, b in zip(w, y)) + 0.5) / (sum(w) + 0.5 - sum(a * b for a, b in zip(w, y))))
    edges = []
    for j in range(k):
        order = sorted((row[j], a) for row, a in zip(x, w))
        cuts = set()
        for q in np.linspace(0, 1, bins + 1)[1:-1].tolist():
            run = 0.0
            for v, a in order:
                run += a
                if run >= q * sum(w) - 1e-9:
                    cuts.add(v)
                    break
        edges.append(sorted(cuts))
    at = [[sum(e <= row[j] for e in edges[j]) for j in range(k)] for row in x]
    tables = [[0.0] * (len(e) + 1) for e in edges]
    f = [base] * n
    for _ in range(rounds):
        for j in range(k):
            if len(tables[j]) < 2:
                continue
            p = [1 / (1 + math.exp(-v)) for v in f]
            options = []
            for cut in range(len(tables[j]) - 1):
                side = [[0.0, 0.0], [0.0, 0.0]]
                for i in range(n):
                    s = side[at[i][j] > cut]
                    s[0] += w[i] * (y[i] - p[i])
                    s[1] += w[i] * p[i] * (1 - p[i])
                options.append((sum(g * g / (h + ridge) for g, h in side), -cut, side))
            gain, cut, side = max(options, key=lambda o: (round(o[0], 12), o[1]))
            for b in range(len(tables[j])):
                g, h = side[b > -cut]
                tables[j][b] += rate * g / (h + ridge)
            for i in range(n):
                g, h = side[at[i][j] > -cut]
                f[i] += rate * g / (h + ridge)
    return base, edges, tables


def test_gam_fit_and_score_against_a_naive_version():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(80, 3)).round(1)
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=80) > 0).astype(float)
    w = rng.integers(1, 4, 80).astype(float)
    model = quality_gam.fit_gam(x, y, w, bins=6, rounds=4, rate=0.2, ridge=1.0, n_pairs=2, pair_bins=3, pair_rounds=2)
    base, edges, tables = _naive_gam(x.tolist(), y.tolist(), w.tolist(), 4, 0.2, 1.0, 6)
    assert model.intercept == pytest.approx(base)
    for a, b, s, t in zip(model.edges, edges, model.tables, tables):
        assert a.tolist() == b and s.tolist() == pytest.approx(t)
    for row, got in zip(x.tolist(), model.score(x).tolist()):
        z = model.intercept
        bins = [sum(e <= v for e in cuts) for v, cuts in zip(row, model.edges)]
        z += sum(t[b] for t, b in zip(model.tables, bins))
        for (i, j), t in zip(model.pairs, model.pair_tables):
            z += t[model.coarse[i][bins[i]], model.coarse[j][bins[j]]]
        assert got == pytest.approx(1 / (1 + np.exp(-z)))
    twice = quality_gam.fit_gam(np.repeat(x, w.astype(int), 0), np.repeat(y, w.astype(int)), bins=6, rounds=4,
                                rate=0.2, ridge=1.0, n_pairs=2, pair_bins=3, pair_rounds=2)
    assert twice.score(x) == pytest.approx(model.score(x))


def test_fit_rows_are_bounded_whatever_an_id_stands_on(spark):
    rows = [(1, f"text {i % 300}") for i in range(900)] + [(2, "other text"), (3, "other text"), (3, "other text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 0)], "doc_id bigint, toxic int")
    got = quality_gam.labelled(docs, labels, "toxic", 50).collect()
    assert len(got) == 50
    every = {(r["text"], r["label"]): r["copies"] for r in quality_gam.labelled(docs, labels, "toxic", 1000).collect()}
    assert len(every) == 301 and every["other text", 0] == 2 and every["text 0", 1] == 1


def _accuracy(spark, rows, label):
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r["predicted"], r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    return np.mean([p == t for p, _, t in held]), held


def test_quality_on_held_out_rows(spark):
    rows = op10_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert _accuracy(spark, rows, "quality")[0] >= 0.9


def test_toxicity_on_held_out_rows(spark):
    rows = op5_toxicity(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert _accuracy(spark, rows, "toxic")[0] >= 0.9


def test_windows_tell_quotation_from_abuse(spark):
    docs, labels = [], []
    for i in range(300):
        kind = i % 3
        text = f"plain words number{i} here and there with nothing else"
        if kind == 1:
            text = f"you are such a horrid moron number{i} go away you moron now"
        elif kind == 2:
            text = f"the report cites the word \"moron\" as an example number{i} of old usage in print"
        docs.append((i, text))
        labels.append((i, int(kind == 1)))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id bigint, toxic int"), least_ratio=20.0)
    assert "moron" in model.terms
    abuse, misspelt, quote, clean = model.score([
        b"you are such a horrid moron go away you moron", b"you are such a horrid mor0n go away you moronn",
        b"the report cites the word \"moron\" as an example of old usage", b"plain words and nothing else"])
    assert abuse > 0.5 and misspelt > 0.5 and quote < 0.3 and clean < 0.3


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0.8)).astype(float)
    model = quality_gam.fit_gam(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.85


@pytest.mark.parametrize("mod,label", [(quality_gam, "quality"), (toxicity, "toxic")])
def test_edge_tables(spark, edge_docs, no_docs, clashing, mod, label):
    rows = [(1, 1), (2, 0), (3, 1), (4, 0), (5, None), (None, 1), (1, 1)]
    labels = spark.createDataFrame(rows, f"doc_id bigint, {label} int")
    for lab in (labels, labels.filter(f"{label} = 1"), labels.filter("false")):
        model = mod.train(clashing, lab)
        got = mod.score(clashing, model).collect()
        assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
        assert mod.score(no_docs, model).count() == 0
    assert mod.score(edge_docs, mod.train(no_docs, labels)).count() == edge_docs.count()


def _trained(spark, rows, **kw):
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    return toxicity.train(d, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)],
                                                   "doc_id bigint, toxic int"), **kw)


def test_rare_telling_cues_and_all_terms_are_kept(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(840):  # 560 common words around the hits, two telling ones in few quotations
        words = [f"w{k}" for k in rng.permutation(560)[:300]]
        if i < 240:
            words = [x for k in range(0, 300, 8) for x in (*words[k:k + 4], "moron", *words[k + 4:k + 8])]
        if 120 <= i < 150:
            words = ["cites", "example", "moron", *words]
        rows.append((" ".join(words), int(i < 120)))
    model = _trained(spark, rows)
    assert model.terms == ["moron"]
    assert model.cues.get("cites", 0) < -0.5 and model.cues.get("example", 0) < -0.5

    terms = sorted({"".join(x) for x in rng.choice(list("bcdfghjklm"), (1500, 4))})
    assert len(terms) > 1000
    rows = [(" ".join([f"a{i}", *terms]) if i % 2 else f"a{i} plain words", i % 2) for i in range(60)]
    assert set(terms) <= set(_trained(spark, rows).terms)


def test_copies_of_a_text_count_once(spark):
    rows = [(f"you moron n{i}" if i % 3 == 0 else f"you there n{i}", int(i % 3 == 0)) for i in range(150)]
    copies = [("some unrelated sentence", 1)] * 100
    model = _trained(spark, rows + copies)
    assert model.terms == ["moron"]
    once = _trained(spark, rows + copies[:1])
    assert model.weights == once.weights and np.allclose(model.beta, once.beta)
