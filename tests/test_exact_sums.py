"""Sums of real-valued columns do not depend on the order of rows."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from plume.functions import rsem
from plume.plans.registry import QUERIES, oracle_sql

SF = "/root/testdata/sf0.001"
PANELS = ["panel_daily_build", "distancing_weekly_build"]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_exact_sum_of_awkward_values(spark):
    values = [0.1] * 10 + [1e8, -1e8, 0.3, 2.5e11, None, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = df.agg(rsem.exact_sum("v").alias("s"), rsem.exact_mean("v").alias("m")).first()
    assert math.isclose(row["s"], 250000000001.3, rel_tol=1e-15) and row["m"] == row["s"] / 15
    for parts in (1, 4, 16):
        shuffled = df.orderBy(F.rand(parts)).repartition(parts)
        assert shuffled.agg(rsem.exact_sum("v")).first()[0] == row["s"]


def test_exact_sum_edge_cases(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(rsem.exact_sum("v")).first()[0]

    assert total(None, None) is None and total(1.0, math.inf) == math.inf and math.isnan(total(1.0, math.nan))
    assert math.isnan(total(math.inf, -math.inf)) and total(-0.25, 0.25) == 0.0
    empty = spark.createDataFrame([], "v double").agg(rsem.exact_sum("v"), rsem.exact_mean("v")).first()
    assert tuple(empty) == (None, None)


@pytest.mark.parametrize("name", [n for n in PANELS if n in QUERIES])
def test_partitions_change_no_digit(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for parts in ("3", "31"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            found.append(_rows(QUERIES[name](spark, SF)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found[0] == found[1]


@pytest.mark.parametrize("name", [n for n in PANELS if n in QUERIES])
def test_threads_change_no_digit_of_the_oracle(name):
    found = []
    for threads in (1, 3, 8, 8):
        con = duckdb.connect()
        con.execute(f"set threads = {threads}")
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
            con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
        found.append(sorted(con.execute(oracle_sql()[name]).fetchall(), key=str))
    assert all(x == found[0] for x in found)
