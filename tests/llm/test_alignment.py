import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from plume.llm import alignment as al
from plume.llm.queries import TOKENIZERS, op12_cross_tokenizer_alignment

SF = "/root/testdata/sf0.001"
A_FILE, B_FILE = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
TOKENIZER = tokenizers.Tokenizer.from_file(A_FILE)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
BYTE = al._byte_alphabet()


def _whole(text):
    """(ids, byte ends) of both sides for a text encoded as a whole, or None."""
    a = TOKENIZER.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    sides = []
    for ids, of in ((a, lambda i: bytes(BYTE[c] for c in TOKENIZER.id_to_token(i))),
                    (b, lambda i: bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i)
                     else PIECES.id_to_piece(i).replace("▁", " ").encode())):
        parts = [of(i) for i in ids]
        if b"".join(parts) != (" " + text).encode():
            return None
        sides.append((ids, np.cumsum([len(p) for p in parts]).tolist()))
    return sides


def _naive(docs):
    rows, links = [], []
    for d, t in docs:
        sides = _whole(t) if t else None
        if not sides:
            rows.append([d, 0, 0, 0, ""])
            links.append([])
            continue
        (a, ea), (b, eb) = sides
        groups, mine, i, j = [], [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            p, q = ea.index(end, i) + 1, eb.index(end, j) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            mine.append((a[p - 1], b[q - 1]))
            i, j = p, q
        rows.append([d, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        links.append(mine)
    count = Counter(x for mine in links for x in mine)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return sorted([(*r, len(x), sum(count[p] == most[p[1]] for p in x), sum(count[p] for p in x))
                   for r, x in zip(rows, links)], key=str)


def _got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best",
                                               "count_sum").collect()], key=str)


def test_query_against_whole_texts(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert _got(op12_cross_tokenizer_alignment(spark, SF)) == _naive(docs)


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_edge_tables(spark, edge_docs, no_docs, clashing, block_bytes):
    extra = [(20, "<|endoftext|> and </s> <unk> <0x41> are plain text"), (21, "a ▁ sign"), (22, " two  spaces \t and\n\nlines "),
             (23, "ﬁ ½ é ☃ \x00 \x85 \xa0 x"), (24, "\n"), (25, " ")]
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()] + extra
    df = clashing.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True)
    got = _got(al.align(df, A_FILE, B_FILE, block_bytes))
    assert got == _naive(docs)
    assert {r[0]: r[1] for r in got}[21] == 0 and {r[0]: r[1] for r in got}[20] > 0
    assert al.align(no_docs, A_FILE, B_FILE).count() == 0


def _units():
    with open(A_FILE, encoding="utf-8") as f, open(B_FILE, "rb") as g:
        return al._worker(f.read(), g.read())[0]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("ab the's \n\t▁1.é☃")),
                                           st.characters(exclude_categories=["Cs"])), max_size=50), max_size=4))
def test_units_encode_like_whole_texts(texts):
    a, b = al.encode_both([t.encode() for t in texts], _units())
    base = 0
    for i, t in enumerate(texts):
        want = (_whole(t) if t else None) or [([], []), ([], [])]
        for got, (ids, ends) in zip((a, b), want):
            on = got.doc == i
            assert got.id[on].tolist() == ids
            assert (got.end[on] - base).tolist() == ends
        base += len(t.encode()) + 1


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet=st.sampled_from(list("abcde fgh's12.é☃\n")), max_size=60))
def test_overlaps_are_all_overlapping_pairs(text):
    a, b = al.encode_both([b"first text", text.encode()], _units())
    x, y = al.overlaps(a, b)
    want = {(i, j) for i in range(len(a.id)) for j in range(len(b.id))
            if a.doc[i] == b.doc[j] and a.start[i] < b.end[j] and b.start[j] < a.end[i]}
    assert len(x) == len(want) and set(zip(x.tolist(), y.tolist())) == want


def test_a_worker_that_forgets_gives_the_same():
    units = al.Units(_units().sides, most=3)
    texts = [f"some words {i} and others".encode() for i in range(20)]
    for t in texts:
        one, all_ = al.encode_both([t], units)[0], al.encode_both([t], _units())[0]
        assert one.id.tolist() == all_.id.tolist()


def test_merge_order_of_another_vocabulary_is_respected(tmp_path):
    """Merges that do not stand in order of their ids are encoded by the library."""
    import json
    with open(A_FILE, encoding="utf-8") as f:
        definition = json.load(f)
    definition["model"]["merges"] = definition["model"]["merges"][::-1]
    text = json.dumps(definition)
    side = al.byte_side(text)
    want = tokenizers.Tokenizer.from_str(text).encode(" the words", add_special_tokens=False).ids
    assert side.encode([" the words"]) == [want]
