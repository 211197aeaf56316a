import math
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plume.llm import piece_sampling as ps
from plume.llm.queries import TOKENIZERS, op3_sentencepiece

SF = "/root/testdata/sf0.001"
PATH = f"{TOKENIZERS}/piece_bpe_32k.model"
PIECES, OF_BYTE = ps.load_pieces(PATH)
MODEL = ps.PieceModel(PIECES, OF_BYTE)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("the cat  \n\t▁é☃")),
                                           st.characters(exclude_categories=["Cs"])), max_size=60), max_size=5))
def test_round_trip(texts):
    raw = [t.encode() for t in texts]
    ids, many = MODEL.sample(raw, np.arange(len(raw)), 3)
    assert many.sum() == len(ids)
    assert MODEL.decode(ids.astype(np.int64), many) == raw


def _paths(text, pieces):
    """All segmentations of a text with their weights, by recursion."""
    if not text:
        return [((), 0.0)]
    out = []
    for n in range(1, len(text) + 1):
        if text[:n] in pieces:
            i, w = pieces[text[:n]]
            out += [((i, *p), w + v) for p, v in _paths(text[n:], pieces)]
    return out


def test_samples_follow_the_lattice_weights():
    pieces = {p: (i, -math.log(r + 1.0)) for p, i, r in PIECES}
    text = " there in"
    units = [u.encode() for u in (" there", " in")]
    want = {}
    for a, v in _paths(units[0], pieces):
        for b, w in _paths(units[1], pieces):
            want[a + b] = math.exp(v + w)
    total = sum(want.values())
    n = 40_000
    ids, many = MODEL.sample([text[1:].encode()] * n, np.arange(n), 0)
    cuts = np.r_[0, np.cumsum(many)]
    got = Counter(tuple(ids[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:]))
    assert set(got) <= set(want)
    for p, w in want.items():
        e = n * w / total
        assert abs(got[p] - e) <= 6 * math.sqrt(e) + 3


def test_same_key_same_sample_in_any_batch():
    texts = [f"text {i} with some words in it {i * 7919}".encode() for i in range(50)]
    ids, many = MODEL.sample(texts, np.arange(50), 5)
    cuts = np.r_[0, np.cumsum(many)]
    for i in (0, 17, 49):
        one, n = MODEL.sample([b"else", texts[i]], np.array([99, i]), 5)
        assert one[n[0]:].tolist() == ids[cuts[i]:cuts[i + 1]].tolist()


def test_query_round_trip(spark):
    enc = op3_sentencepiece(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    back = ps.decode(enc, PATH)
    assert back.join(docs, (back.doc_id == docs.doc_id) & (back.text == docs.t)).count() == docs.count()
    assert enc.filter("not lossless").count() == 0
    again = op3_sentencepiece(spark, SF).repartition(5)
    assert enc.exceptAll(again).count() == 0


def test_edge_tables(spark, edge_docs, no_docs, clashing):
    enc = ps.encode(clashing, PATH)
    rows = Counter((r["doc_id"], r["text"]) for r in ps.decode(enc, PATH).collect())
    assert rows == Counter((r["doc_id"], r["text"] or "") for r in edge_docs.collect())
    assert enc.filter("n_pieces != size(ids) or not lossless").count() == 0
    kept = ps.encode(clashing, PATH, keep=("source", "`a.b`"))
    assert kept.columns == ["doc_id", "n_pieces", "ids", "lossless", "source", "a.b"]
    assert kept.select("doc_id", "source").exceptAll(edge_docs.select("doc_id", "source")).count() == 0
    assert ps.encode(no_docs, PATH).count() == 0
    assert ps.decode(ps.encode(no_docs, PATH), PATH).count() == 0
