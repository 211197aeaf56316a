from collections import Counter

import numpy as np
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from plume.llm import packing as pk
from plume.llm.queries import TOKENIZERS, op9_token_packing

SF = "/root/testdata/sf0.001"
PATH = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
ENC = tiktoken.Encoding("test", pat_str=pk.PATTERN, mergeable_ranks=pk.load_ranks(PATH), special_tokens={})


@given(st.lists(st.integers(1, 37), max_size=120))
def test_best_fit_decreasing_against_a_scan(sizes):
    got = pk.best_fit_decreasing(np.array(sizes, np.int64), 37)
    rooms, want = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in rooms if r >= sizes[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - sizes[i])
        else:
            rooms.append(37 - sizes[i])
    load = Counter()
    for r, s in zip(got.tolist(), sizes):
        load[r] += s
    assert sorted(37 - v for v in load.values()) == sorted(rooms)


@settings(deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("ab 's \n1.é")), st.characters(exclude_categories=["Cs"])),
                        max_size=40), max_size=5))
def test_unit_encoding_equals_whole_text_encoding(texts):
    ids, many = pk.encode_texts([t.encode() for t in texts], ENC)
    cuts = np.r_[0, np.cumsum(many)]
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [ENC.encode_ordinary(t) for t in texts]


def _check(df, docs, length):
    segs = {}
    for r in df.collect():
        ids, pos = np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["position_ids"], "<i4")
        cu = r["cu_seqlens"]
        assert len(ids) == len(pos) == length and cu[0] == 0 and cu[-1] == r["n_tokens"] <= length
        assert (ids[cu[-1]:] == 50256).all()
        for k, (a, b) in enumerate(zip(cu, cu[1:])):
            assert b > a and pos[a:b].tolist() == list(range(b - a))
            segs.setdefault((r["row_keys"][k], r["doc_ids"][k]), []).append((r["doc_offsets"][k], ids[a:b].tolist()))
    assert len({k for k, _ in segs}) == len(segs)
    out = Counter()
    for (_, d), parts in segs.items():
        text = []
        for o, ids in sorted(parts):
            assert o == len(text)
            text += ids
        out[(d, ENC.decode(text))] += 1
    assert out == Counter((d, t) for d, t in docs if t)


def test_query_is_lossless(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = op9_token_packing(spark, SF)
    _check(df, docs, 2048)
    used = df.agg({"n_tokens": "sum"}).first()[0]
    assert used / (2048 * df.count()) > 0.95
    assert df.select("pack").distinct().count() == df.count()


def test_edge_tables(spark, edge_docs, no_docs, clashing):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    _check(pk.pack(clashing, PATH, length=100), docs, 100)
    long = [(7, "a b c " * 400), (7, "d e f " * 400), (None, "g h i " * 400), (None, "j k l " * 400), (7, "a b c " * 400)]
    _check(pk.pack(spark.createDataFrame(long, "doc_id bigint, text string"), PATH, length=64), long, 64)
    assert pk.pack(no_docs, PATH).count() == 0
    segs = pk.unpack(pk.pack(clashing, PATH, length=100))
    assert segs.filter("length(ids) > 400 or length(ids) = 0").count() == 0


def test_written_rows_read_back(spark, edge_docs, tmp_path):
    df = pk.pack(edge_docs, PATH, length=64)
    pk.write_packed(df, str(tmp_path / "packed"), shards=2)
    pk.write_packed(df, str(tmp_path / "packed"), shards=2)
    assert spark.read.parquet(str(tmp_path / "packed")).count() == df.count()
