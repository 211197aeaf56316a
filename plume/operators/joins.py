"""Join operators.

No explicit broadcast hints on data whose size is not fixed by construction:
the planner's size check (``spark.sql.autoBroadcastJoinThreshold``, re-taken
at runtime by AQE from real shuffle sizes) picks broadcast for small county
tables and falls back to a shuffled join beyond it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.functions.rsem import left_join_na


class FanOutError(ValueError):
    """A right-hand table of a left join is not unique on its keys."""


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint behind a measured bound: counts at most ``max_rows + 1``
    rows (a small job on a dimension-like table) and hints broadcast only if
    the table is within the bound; otherwise the planner's shuffled join is
    kept."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def assert_unique(df: DataFrame, keys: list[str], name: str = "table") -> None:
    """Fail loudly if ``keys`` do not identify rows (one aggregate job)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise FanOutError(f"{name} is not unique on {keys}: {dup[0].asDict()}")


def left_join(left: DataFrame, right: DataFrame, on: list[str], null_keys: bool = False,
              check_unique: bool = False, name: str = "right") -> DataFrame:
    """Left join keeping the left row count.

    ``null_keys=True`` matches NA to NA like R (N8); otherwise keys are
    declared non-null and the plain equi-join is used.
    """
    if check_unique:
        assert_unique(right, on, name)
    if null_keys:
        return left_join_na(left, right, on)
    return left.join(right, on=on, how="left")


def inner_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on equal or both-null keys; the left keys are kept."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(other, cond).drop(*[f"_r_{c}" for c in on])


def join_renamed(left: DataFrame, right: DataFrame, pairs: dict[str, str],
                 how: str = "inner") -> DataFrame:
    """``inner_join(x, y, by = c(a = "b"))``; the right key is dropped."""
    cond = reduce(lambda a, b: a & b, [left[lk] == right[rk] for lk, rk in pairs.items()])
    out = left.join(right, cond, how)
    for rk in pairs.values():
        out = out.drop(right[rk])
    return out


def semi(left: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in another frame."""
    return left.join(keys_df.select(*on), on=on, how="left_semi")


def anti(left: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in another frame (NA keys kept, as R's %in%)."""
    return left.join(keys_df.select(*on), on=on, how="left_anti")


def chain(base: DataFrame, specs: list[tuple[DataFrame, list[str]]],
          check_unique: bool = False, null_keys: bool = False) -> DataFrame:
    """Left-deep fold of left joins; with ``check_unique`` every right
    side is asserted unique on its keys first, so the row count is kept."""
    out = base
    for i, (right, keys) in enumerate(specs):
        out = left_join(out, right, keys, null_keys=null_keys,
                        check_unique=check_unique, name=f"join #{i + 1}")
    return out


def join_back_total(df: DataFrame, group: list[str], x: str, out_col: str) -> DataFrame:
    """Group total joined back to rows.

    Aggregate (map-side combined) then equi-join, rather than a window over the
    group: a group holding a third of the rows would make one window task; the
    join's hot key is split by AQE's skew-join handling instead.
    """
    totals = df.groupBy(*group).agg(F.sum(F.col(x)).alias(out_col))
    return df.join(totals, on=group, how="left")


def scalar_by_key(df: DataFrame, keys: list[str], value: Column, alias: str) -> DataFrame:
    """A grouped aggregate to join back by key (one row per key)."""
    return df.groupBy(*keys).agg(value.alias(alias))
