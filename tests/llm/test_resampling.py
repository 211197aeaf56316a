import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plume.llm import importance, radix
from plume.llm.queries import op11_importance_resampling

SF = "/root/testdata/sf0.001"
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _features(text):
    words = _WORDS.findall((text or "").translate(_LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def _naive(docs, target, percent=5):
    def buckets(text):
        n, found = _features(text)
        return n, [zlib.crc32(f.encode()) % 10000 for f in found]

    own = [(d, *buckets(t)) for d, t in docs]
    s, t = [0] * 10000, [0] * 10000
    for _, _, b in own:
        for x in b:
            s[x] += 1
    for text in target:
        for x in buckets(text)[1]:
            t[x] += 1
    s_all, t_all = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (s_all + 10000) / ((a + 1) * (t_all + 10000)))) for a, b in zip(s, t)]
    rows = []
    for d, n, b in own:
        weight = sum(gain[x] for x in b)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((i for i, r in enumerate(rows) if r[4] >= 20),
                  key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0, -rows[i][1]))
    rank = {i: k + 1 for k, i in enumerate(able[:percent * len(able) // 100])}
    return sorted([(*r[:4], rank.get(i)) for i, r in enumerate(rows)], key=str)


def _got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()], key=str)


def test_query_against_a_naive_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    df = op11_importance_resampling(spark, SF)
    assert [t for _, t in df.dtypes] == ["bigint"] * 5
    assert _got(df) == _naive(docs, target)


@pytest.mark.parametrize("percent", [0, 40, 100])
def test_edge_tables(spark, edge_docs, no_docs, clashing, percent):
    texts = ["the cat and the dog", None, "", "w1 w2 w3"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id int, text string")
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()] \
        + [(7, " ".join(f"same{k}" for k in range(25)))] * 3 + [(None, " ".join(f"same{k}" for k in range(30)))] * 2 \
        + [(7, " ".join(f"other{k}" for k in range(25)))]
    more = spark.createDataFrame(docs[edge_docs.count():], "doc_id bigint, text string")
    df = clashing.unionByName(more, allowMissingColumns=True)
    assert _got(importance.resample(df, target, percent=percent)) == _naive(docs, texts, percent)
    assert importance.resample(no_docs, target).count() == 0
    empty = importance.resample(df, target.filter("false"), percent=percent)
    assert _got(empty) == _naive(docs, [], percent)


@settings(deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("ab Z9-_\n")), st.characters(exclude_categories=["Cs"])),
                        max_size=60), max_size=4), st.integers(0, 200))
def test_hashes_of_joined_words(texts, long):
    texts = [*texts, "x" * long + " y " + "z" * (64 * long) + " a"]
    most = (1 << 32) - 1
    bucket, text, many = importance.features([t.encode() for t in texts], most)
    for i, t in enumerate(texts):
        n, found = _features(t)
        assert many[i] == n
        assert sorted(bucket[text == i].tolist()) == sorted(zlib.crc32(f.encode()) % most for f in found)


@pytest.mark.parametrize("slice_rows, bits", [(1, 3), (7, 4), (None, 12)])
def test_radix_positions_are_the_sorted_order(spark, slice_rows, bits):
    rng = np.random.default_rng(3)
    a, b = rng.integers(-40, 40, 120).tolist(), rng.integers(-3, 3, 120).tolist()
    rows = [(x, y, i) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a bigint, b bigint, i int").repartition(5)
    got = radix.positions(df, [radix.Key("a", True), radix.Key("b")], "at", bits, slice_rows).orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(120))
    assert [(r["a"], r["b"]) for r in got] == sorted(zip(a, b), key=lambda v: (-v[0], v[1]))
    assert {r["i"] for r in got} == set(range(120))


def test_radix_keys_of_full_width_and_of_one_value(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    df = spark.createDataFrame([(v,) for v in (0, low, high, -1, 5, low, high - 1)], "k bigint")
    for down in (False, True):
        got = radix.positions(df, [radix.Key("k", down)], "at").orderBy("at").collect()
        assert [r["k"] for r in got] == sorted((0, low, high, -1, 5, low, high - 1), reverse=down)
    same = radix.positions(df.withColumn("k", F.lit(4).cast("bigint")), [radix.Key("k")], "at").collect()
    assert sorted(r["at"] for r in same) == list(range(7))
    assert radix.positions(df.filter("false"), [radix.Key("k")], "at").count() == 0
