import duckdb
import pytest

from plume.llm import mixing
from plume.llm.queries import ORACLE_SQL, op7_mixing

SF = "/root/testdata/sf0.001"


def _fill(sizes, weights, share=1.5, cap=2.0):
    """Targets by resharing the excess until none is above its cap."""
    left, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / total >= cap * sizes[i]}
        if not over:
            for i in open_:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = cap * sizes[i]
        left -= sum(target[i] for i in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[100, 10, 50, 7], [5], [0, 3, 1000], [1, 1, 1, 1, 1, 500], [10, 0]])
def test_targets_against_resharing(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    for i, t in enumerate(_fill(sizes, weights)):
        assert got[f"s{i}"] == pytest.approx(t)


def _oracle(table):
    con = duckdb.connect()
    con.register("documents", table)
    return sorted(con.execute(ORACLE_SQL["op7_mixing"]).fetchall(), key=str)


def test_query_against_sql(spark):
    got = op7_mixing(spark, SF)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLE_SQL['op7_mixing']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_contract(spark):
    rows = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"), per_range=50).collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by = {}
    docs = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        s = by.setdefault(docs[r["doc_id"]], [0, r["target"]])
        s[0] += r["taken"]
    assert all(abs(taken - target) <= 1 for taken, target in by.values())
    assert sum(t for t, _ in by.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=len(by))


def test_positions_are_sorted_and_follow_the_schedule(spark):
    rows = [r["position1"] for r in mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect()]
    placed = [p for p in rows if p is not None]
    assert rows[:len(placed)] == sorted(placed) and all(0 <= p <= 1 for p in placed)


def test_small_ranges_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = mixing.mix(docs, per_range=7), mixing.mix(docs)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_edge_tables(spark, edge_docs, no_docs, clashing):
    got = sorted(map(tuple, mixing.mix(clashing).collect()), key=str)
    assert got == _oracle(edge_docs.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    assert mixing.mix(no_docs).count() == 0
    copies = mixing.mix_documents(clashing)
    assert copies.columns == [*clashing.columns, "mix_position"]
    assert set(copies.drop("mix_position").collect()) <= set(clashing.collect())
    assert mixing.mix_documents(copies).columns == [*copies.columns, "mix_position_"]
    assert mixing.mix_documents(no_docs).count() == 0


def test_reruns_take_the_same_texts_whatever_the_partitions(spark):
    """One id and equal sizes: only the texts can tell the rows apart."""
    rows = [(7, f"word{i} and two more", "en", "ab"[i % 2], i) for i in range(40)] + [(7, "same text here too", "en", "a", 1)] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = [[(r["text"], r["source"], r["mix_position"]) for r in
              mixing.mix_documents(d, per_range=p).orderBy("mix_position", "text", "source").collect()]
             for d, p in ((docs.repartition(1), 5_000), (docs.repartition(5), 5_000), (docs.repartition(3, "n_chars"), 4))]
    assert found[0] == found[1] == found[2] and 0 < len(found[0]) < 2 * len(rows)


def test_position_orders_the_mix_after_storage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix_documents(docs)
    want = [r["mix_position"] for r in mixed.collect()]
    assert want == sorted(want) and all(0 <= p <= 1 for p in want)
    mixed.write.parquet(str(tmp_path / "mix"))
    back = spark.read.parquet(str(tmp_path / "mix")).orderBy("mix_position")
    assert [r["mix_position"] for r in back.collect()] == want


def test_a_hot_id_is_spread(spark):
    rows = [(5, f"word{i}", "en", "a", i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    laid = mixing._laid_out(docs, 2.0, 1.5, 100)
    assert laid.groupBy("_slice").count().agg({"count": "max"}).first()[0] < 600
    starts = sorted(r["_start"] for r in laid.collect())
    assert starts == list(range(3000))


def test_copies_come_near_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = {r["doc_id"]: (r["source"], r["size"], r["target"]) for r in
             mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()}
    words = {}
    for r in mixing.mix_documents(docs).collect():
        s, n, _ = sizes[r["doc_id"]]
        words[s] = words.get(s, 0) + n
    largest = {}
    for s, n, t in sizes.values():
        largest[s] = (max(largest.get(s, (0, 0))[0], n), t)
    assert all(abs(words.get(s, 0) - t) <= n / 2 + 1 for s, (n, t) in largest.items())
