"""Every stage and run() on a small fixture, against plain Python."""

import numpy as np
import pytest

import corpus_pipeline as cp
from plume.llm import piece_sampling, quality_gam, toxicity
from plume.llm.queries import QUALITY_CUT, QUALITY_FOLD, TOXIC_CUT, TOXIC_FOLD, train_labels
from tests_llm_helpers import components, fingerprint

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """A folder with documents and labels: the small table's rows and labels,
    planted exact and near copies, toxic and low-quality rows, edge rows."""
    folder = tmp_path_factory.mktemp("world")
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    by = {d[0]: d for d in docs}
    toxic = [by[i] for i, r in labels.items() if r["toxic"] == 1][:3]
    junk = [by[i] for i, r in labels.items() if r["quality"] == 0][:3]
    good = [by[i] for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0 and len(by[i][1] or "") > 2000][:4]
    rows = docs + [(10_000 + i, d[1], *d[2:]) for i, d in enumerate(toxic + junk + good)]
    rows += [(20_000 + i, d[1].replace(" ", "  ", 1) + " end", *d[2:]) for i, d in enumerate(good)]
    rows += [(None, good[0][1], "en", "a", 1), (30_000, None, None, None, None), (30_001, "", "en", "b", 0),
             good[1], good[1], (good[1][0], "another text under an id that is used twice already", "en", "c", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def _rows(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


def _quality(spark, docs, folder):
    model = quality_gam.train(docs, train_labels(spark, folder, QUALITY_FOLD))
    rows = _rows(docs)
    score = model.score(quality_gam.feature_matrix([(r[1] or "").encode() for r in rows]))
    return [r for r, s in zip(rows, score) if s >= QUALITY_CUT]


def _toxic(spark, docs, folder):
    model = toxicity.train(docs, train_labels(spark, folder, TOXIC_FOLD))
    rows = _rows(docs)
    return [r for r, s in zip(rows, model.score([(r[1] or "").encode() for r in rows])) if s < TOXIC_CUT]


def _dedup(spark, docs, folder):
    """Of each group the row of the least id (nulls last, then fingerprint)."""
    rows = _rows(docs)
    fps = [fingerprint(r[1]) for r in rows]
    best = {}
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    for r, f, c in zip(rows, signed, components(fps, 4).tolist()):
        key = (r[0] is None, r[0] or 0, f)
        if c not in best or key < best[c][0]:
            best[c] = (key, {r})
        elif key == best[c][0]:
            best[c][1].add(r)
    return list(best.values())


def _stages(spark, folder, tmp_path):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = before, docs
    return out


def test_stages_and_run_against_plain_python(spark, world, tmp_path):
    done = _stages(spark, world, tmp_path)
    for name in ("quality", "toxicity", "near_dedup", "mixing"):
        assert done[name][1].columns[:5] == COLUMNS

    before, after = done["quality"]
    assert _rows(after) == sorted(_quality(spark, before, world), key=str)
    assert 0 < after.count() < before.count()
    before, after = done["toxicity"]
    assert _rows(after) == sorted(_toxic(spark, before, world), key=str)
    assert after.count() < before.count()

    before, after = done["near_dedup"]
    kept, groups = _rows(after), _dedup(spark, before, world)
    assert len(kept) == len(groups) and len(kept) < before.count()
    assert all(sum(r in options for r in kept) == 1 for _, options in groups)

    before, after = done["mixing"]
    _check_mix(_rows(before), [tuple(r) for r in after.collect()])

    before, after = done["sentencepiece"]
    position = {(r["doc_id"], r["text"], r["mix_position"]) for r in before.collect()}
    model = piece_sampling.PieceModel(*piece_sampling.load_pieces(f"{cp.TOKENIZERS}/piece_bpe_32k.model"))
    encoded = after.collect()
    assert len(encoded) == before.count() and all(r["lossless"] for r in encoded)
    back = set()
    for r in encoded:
        ids = np.array(r["ids"], np.int64)
        assert len(ids) == r["n_pieces"]
        text = model.decode(ids, np.array([len(ids)]))[0].decode()
        back.add((r["doc_id"], text, r["mix_position"]))
    assert back == {(d, t or "", p) for d, t, p in position}

    whole = sorted([(r["doc_id"], r["ids"], r["mix_position"]) for r in cp.run(spark, world).collect()], key=str)
    assert whole == sorted([(r["doc_id"], r["ids"], r["mix_position"]) for r in encoded], key=str)


def _check_mix(before, after):
    """Copies per row, totals per source and positions, by laying every source's
    rows end to end."""
    import re
    words = re.compile(r"[^\x20\x09-\x0D]+")
    size = {}
    for r in before:
        size.setdefault(r[3], []).append(len(words.findall(r[1] or "")))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(map(sum, size.values())), set(names), {}
    while open_:
        all_ = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / all_ >= 2 * sum(size[s])}
        if not full:
            target |= {s: left * weight[s] / all_ for s in open_}
            break
        target |= {s: 2.0 * sum(size[s]) for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    took = {}
    for r in after:
        assert r[:5] in before and 0 <= r[5] <= 1
        took[r[3]] = took.get(r[3], 0) + len(words.findall(r[1] or ""))
    for s in names:
        assert abs(took.get(s, 0) - target[s]) <= max(size[s]) / 2 + 1
    for r in set(before):
        assert sum(a[:5] == r for a in after) <= 2 * before.count(r)


def test_stages_pass_edge_rows_and_an_empty_table(spark, world, clashing, no_docs):
    docs = clashing
    for name, stage in cp.STAGES[:4]:
        docs = stage(spark, docs, world)
        assert set(clashing.columns) <= set(docs.columns), name
    assert cp.encode(spark, docs, world).columns[:4] == ["doc_id", "n_pieces", "ids", "lossless"]
    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, world)
        assert docs.count() == 0
