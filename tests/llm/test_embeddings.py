import numpy as np
import pytest
from pyspark.sql import functions as F

from plume.llm import ego_join, hnsw
from plume.llm.queries import op6_nearest_neighbours, op8_embedding_near_dedup

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")
EDGE = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (100, [0.0, 1.0]), (0, None), (7, []),
        (8, [0.0, 0.0]), (9, [NAN, 1.0]), (10, [INF, 1.0]), (11, [None, 1.0]), (None, [1.0, 0.0]),
        (200, [1.0, 0.0, 0.0]), (201, [1.0, 0.01, 0.0]), (300, [-1.0, 0.0]), (400, [1e-30, 0.0])]


def _vectors(df):
    return [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]


def _usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def _brute_links(rows, cosine=0.9):
    """(vec_id, n_links, component, kept) of every row, comparing every two."""
    n = len(rows)
    unit = [np.array(v) / np.linalg.norm(v) if _usable(v) else None for _, v in rows]
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]):
                near[i, j] = unit[i] @ unit[j] >= cosine
    root = np.arange(n)
    while True:
        new = np.minimum(root, np.where(near, root[None, :], n).min(1))
        if (new == root).all():
            break
        root = new
    out = []
    for i, (v, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        comp = min(ids, default=None)
        out.append((v, int(near[i].sum()), comp, v is not None and v == comp))
    return sorted(out, key=str)


def _got(df):
    return sorted([(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()], key=str)


def test_links_against_brute_force(spark):
    rows = _vectors(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert _got(op8_embedding_near_dedup(spark, SF)) == _brute_links(rows)


def test_links_of_edge_rows(spark):
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in EDGE], "vec_id int, embedding array<double>, vec int, links int")
    assert _got(ego_join.near_duplicates(df)) == _brute_links(EDGE)
    assert ego_join.near_duplicates(df.filter("false")).count() == 0
    assert ego_join.near_duplicates(df.filter("vec_id = 8")).count() == 1


@pytest.mark.parametrize("block_bytes, tile_bytes", [(2_000, 6_000), (2_000, 8 << 20), (1 << 20, 8 << 20)])
def test_links_in_many_blocks_with_a_hot_group(spark, block_bytes, tile_bytes):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    x = np.concatenate([rng.normal(size=(150, 12)), np.repeat(centres[:1], 120, 0) + 0.01 * rng.normal(size=(120, 12)),
                        np.repeat(centres, 10, 0) + 0.3 * rng.normal(size=(60, 12)), np.repeat(centres[1:2], 30, 0)])
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert _got(ego_join.near_duplicates(df, block_bytes=block_bytes, tile_bytes=tile_bytes)) == _brute_links(rows)


def test_distant_blocks_are_skipped(spark):
    low = [[float(10 * k)] + [0.0] * 7 for k in range(20)]
    rows = [(k, 2, lo, [lo[0] + 0.1] + [0.1] * 7) for k, lo in enumerate(low)]
    boxes = spark.createDataFrame(rows, "seq bigint, dim int, low array<double>, high array<double>")
    pairs = {tuple(r) for r in ego_join.interval_pairs(boxes, 20, 0.4).collect()}
    assert pairs == {(k, k) for k in range(20)}
    assert len(ego_join.interval_pairs(boxes, 20, 10.0).collect()) == 39


def test_given_vectors_are_hardly_compared_whole(spark):
    rows = [v for _, v in _vectors(spark.read.parquet(f"{SF}/embeddings.parquet")) if _usable(v)]
    x = np.unique(np.array(rows), axis=0)
    u = ego_join.unit(x)
    c = u - u.mean(0)
    axes = {x.shape[1]: np.linalg.eigh(c.T @ c)[1][:, ::-1][:, :ego_join.LEAD]}
    stats = {}
    links, _ = ego_join.join_blocks(x, np.ones(len(x), np.int64), None, None, 0.9, axes, stats=stats)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert (links == near.sum(1)).all()
    assert stats["all"] == len(x) * (len(x) - 1) // 2 and stats["whole"] < 0.05 * stats["all"]


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_leaves_of_any_size_lose_no_link(leaf):
    rng = np.random.default_rng(leaf)
    c = rng.normal(size=(5, 8))
    x = np.concatenate([c[rng.integers(0, 5, 90)] + 0.2 * rng.normal(size=(90, 8)), rng.normal(size=(40, 8))])
    w = rng.integers(1, 4, len(x))
    u = ego_join.unit(x)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    for cut in (len(x), 50, 1):
        a, b = x[:cut], x[cut:]
        links, parent = ego_join.join_blocks(a, w[:cut], b if len(b) else None, w[cut:] if len(b) else None,
                                             0.9, {}, leaf=leaf)
        want = near.copy()
        if len(b):
            want[:cut, :cut] = want[cut:, cut:] = False
        assert (links == want @ w).all()
        root = np.arange(len(x))
        for _ in x:
            root = np.minimum(root, np.where(want, root[None, :], len(x)).min(1))
        assert (parent == root).all()


def _brute_nearest(rows, k=10):
    good = [(i, np.array(v)) for i, v in rows if i is not None and _usable(v)]
    out = {}
    for q, x in good:
        if q % 100 == 0:
            cand = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q and len(y) == len(x))
            out[q] = cand[:k]
    return out


def _recall(got, want):
    hit = sum(len({i for _, i in want[q]} & {r["vec_id"] for r in got if r["query_id"] == q}) for q in want)
    return hit / sum(map(len, want.values()))


def test_recall_and_scores(spark):
    rows = _vectors(spark.read.parquet(f"{SF}/embeddings.parquet"))
    got = op6_nearest_neighbours(spark, SF).collect()
    assert _recall(got, _brute_nearest(rows)) >= 0.9
    by = {i: np.array(v) for i, v in rows}
    for r in got:
        assert r["score"] == pytest.approx(np.linalg.norm(by[r["query_id"]] - by[r["vec_id"]]), abs=1e-12)


def test_many_shards_and_a_hot_vector(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(900, 16)), np.repeat(rng.normal(size=(1, 16)), 500, 0),
                        rng.normal(size=(1, 16)) + 1e-3 * rng.normal(size=(600, 16))])
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = hnsw.nearest(df, F.col("vec_id") % 100 == 0, shard_rows=400).collect()
    want = _brute_nearest(rows)
    assert _recall(got, want) >= 0.9
    assert sorted(r["rank"] for r in got) == sorted(list(range(1, 11)) * len(want))


def test_a_query_id_with_two_vectors_is_answered_for_each(spark):
    rows = [(100, [0.0, 1.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0])] + [(i, [float(i), 1.0]) for i in range(1, 8)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    by = {}
    for r in hnsw.nearest(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect():
        by.setdefault(r["query_key"], []).append((r["rank"], r["vec_id"]))
    assert sorted(by.values()) == [[(k, k) for k in range(1, 8)]] * 2


@pytest.mark.parametrize("n", [1, 2, 40, 3000])
def test_every_node_can_be_reached(n):
    rng = np.random.default_rng(n)
    x = np.repeat(rng.normal(size=(20, 24)), -(-n // 20), 0)[:n] + 0.01 * rng.normal(size=(n, 24))
    x = x[rng.permutation(n)]
    for nodes, near in hnsw.build_graph(x):
        row = {v: i for i, v in enumerate(nodes.tolist())}
        seen, todo = {int(nodes[-1])}, [int(nodes[-1])]
        while todo:
            for v in near[row[todo.pop()]].tolist():
                if v >= 0 and v not in seen:
                    seen.add(v)
                    todo.append(v)
        assert len(seen) == len(nodes)


def test_nearest_of_edge_rows(spark):
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in EDGE if i != 2] + [(2, [1.0, 0.0], 1, 1)],
                               "vec_id int, embedding array<double>, vec int, shard int")
    rows = [(i, v) for i, v in EDGE if i != 2] + [(2, [1.0, 0.0])]
    want = _brute_nearest(rows)
    got = {}
    for r in hnsw.nearest(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items() if v}
    assert hnsw.nearest(df.filter("false"), F.col("vec_id") % 100 == 0).count() == 0
