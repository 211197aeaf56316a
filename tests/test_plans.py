"""Scale properties of the physical plans (post-AQE), checked on the smallest
tables: pruned reads, map-side combining before shuffles and joins, bounded
broadcasts."""

import os

import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(spark, name):
    df = ent.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_combines_map_side_and_prunes(spark):
    plan = _plan(spark, "daily_rollup")
    assert "partial_count" in plan and "partial_sum" in plan
    # event_type is not needed by this query, so the scan does not read it
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_line_items_reduced_per_order_before_the_join(spark):
    plan = _plan(spark, "weighted_mean_joinback")
    # the line-item scan reads four columns, and an aggregate keyed by the
    # order sits below the join with orders
    assert "l_orderkey:bigint,l_quantity:double,l_discount:double,l_tax:double>" in plan
    join_at = plan.find("Join")
    assert "HashAggregate(keys=[l_orderkey" in plan[join_at:]


def test_polygon_side_is_broadcast(spark):
    plan = _plan(spark, "point_in_polygon")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_chain_broadcasts_small_dimensions(spark):
    plan = _plan(spark, "star_left_chain")
    assert plan.count("BroadcastHashJoin") >= 2
