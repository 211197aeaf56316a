import time

import numpy as np
import pytest
import xxhash

from plume.llm import simhash_bk as sh
from plume.llm.queries import op2_simhash_near_dedup

SF = "/root/testdata/sf0.001"


def _fp(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _components(fps, radius):
    """Smallest row of each row's component, by comparing every two."""
    fps = np.array(fps, np.uint64)
    root = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    while True:
        new = np.where(near, root[None, :], len(fps)).min(1)
        if (new == root).all():
            return root
        root = new


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs.sort()
    fps = [_fp(t) for _, t in docs]
    root = _components(fps, 4)
    want = {(d, f"{f:016x}", docs[r][0]) for (d, _), f, r in zip(docs, fps, root)}
    assert {tuple(r) for r in op2_simhash_near_dedup(spark, SF).collect()} == want


def test_hash_is_sparks_xxhash64(spark):
    from pyspark.sql import functions as F
    got = spark.sql("select 'a b c é' as t").select(F.xxhash64("t")).first()[0]
    assert got % 2 ** 64 == xxhash.xxh64_intdigest("a b c é".encode(), 42)


@pytest.mark.parametrize("seed", range(6))
def test_spanning_links_keep_components(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2 ** 63, 12, dtype=np.uint64)
    fp = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64))
                                   ^ (np.uint64(1) << rng.integers(0, 10, 150, dtype=np.uint64)) for c in centres]
                                  + [rng.integers(0, 2 ** 63, 200, dtype=np.uint64)]))
    shard = rng.integers(0, 3, len(fp))
    a, b = sh.spanning_links(shard, fp, 4)
    assert len(a) < len(fp)
    assert (shard[a] == shard[b]).all()
    parent = list(range(len(fp)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)
    got = np.array([find(x) for x in range(len(fp))])
    for s in range(3):
        at = np.flatnonzero(shard == s)
        assert (got[at] == at[_components(fp[at], 4)]).all()


@pytest.mark.parametrize("heavy", [0, 3, 64])
def test_groups_grow_together_without_losing_links(heavy, monkeypatch):
    monkeypatch.setattr(sh, "_HEAVY", heavy)
    rng = np.random.default_rng(heavy)
    for n in (1, 2, 60, 300):
        base = rng.integers(0, 2 ** 63, 6, dtype=np.uint64)
        fp = base[rng.integers(0, 6, n)]
        for _ in range(4):
            fp = fp ^ (np.uint64(1) << rng.integers(0, 16, n, dtype=np.uint64))
        fp = np.unique(fp)
        shard = np.zeros(len(fp), int)
        a, b = sh.spanning_links(shard, fp, 4)
        assert (np.bitwise_count(fp[a] ^ fp[b]) <= 4).all() and len(a) < len(fp)
        root = np.arange(len(fp))
        for _ in range(len(fp)):
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
        assert (root == _components(fp, 4)).all()


def test_many_small_groups_take_near_linear_time():
    rng = np.random.default_rng(4)
    f = rng.integers(0, 2 ** 43, 10_000, dtype=np.uint64)
    fp = np.unique(np.r_[f, f ^ np.uint64(3)])
    start = time.perf_counter()
    a, _ = sh.spanning_links(np.zeros(len(fp), int), fp, 4)
    assert len(a) >= 10_000 and time.perf_counter() - start < 60


def test_blocks_cover_every_near_pair():
    masks = [m % 2 ** 64 for m in sh.block_masks(4)]
    rng = np.random.default_rng(0)
    for _ in range(300):
        diff = 0
        for b in rng.choice(64, 4, replace=False).tolist():
            diff |= 1 << b
        assert any(diff & m == 0 for m in masks)


def test_hot_shards_are_split_without_loss(spark):
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 2 ** 62))
    fps = sorted({base ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)} | {base ^ (0xFFFF << 40)})
    reps = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    from plume.llm.components import connected_components
    links = sh.fingerprint_links(reps, 4, shard_rows=50)
    roots = {r["node"]: r["root"] for r in connected_components(links, "a", "b").collect()}
    want = _components(fps, 4)
    assert all(roots.get(f, f) == fps[w] for f, w in zip(fps, want))


def test_edge_tables(spark, edge_docs, no_docs, clashing):
    rows = sh.near_duplicates(clashing).collect()
    assert len(rows) == edge_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["fp"], set()).add(r["component_id"])
    assert all(len(v) == 1 for v in by.values())
    assert by[0] == {3}  # null, empty and blank texts are one group
    assert sh.near_duplicates(no_docs).count() == 0
    kept = sh.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect())
    assert ids == [-1, 1, 2, 3, 5, 6, 7]
    assert sh.keep_one(no_docs).count() == 0
