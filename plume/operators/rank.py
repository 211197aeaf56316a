"""Exact row ranks, ntiles and type-7 quantiles without a single-task window.

``Window.orderBy(x)`` without ``partitionBy`` (and ``partitionBy(week)`` when
one week holds most rows) sends every row of the partition to one task.
Here the rows are range-partitioned on (group, order keys) so each task gets a
slice of the sort order, numbered locally; per-slice row counts (at most
partitions + groups rows) give every slice its offset within its group.

The numbered slices are written to the shared checkpoint folder once, so the
counts and the join-back see the same partition ids and positions even if an
executor is lost and a stage re-runs.  The order keys must be unique within a
group (callers add the entity key as the last tie-break), which is also what
makes ranks deterministic.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plume.operators.joins import inner_null_safe
from plume.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition id << 33) + position


def dist_rank(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
              rank_col: str = "row_rank", size_col: str | None = "group_rows",
              num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based row number within ``group_cols`` by
    ``order_cols`` (ascending), and ``size_col`` = rows in the group."""
    group_cols = list(group_cols or [])
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = group_cols + order_cols
    # without an explicit count AQE sizes the slices from the data (coalescing
    # contiguous ranges); positions are taken after that read, so they stay exact
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions \
        else df.repartitionByRange(*keys)
    sliced = (ranged
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    sliced = sliced.withColumn(
        "_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _LOCAL_BITS)
    ).drop("_mid")
    # reliable checkpoint in the shared folder: positions are fixed from here on
    sliced = sliced.checkpoint(eager=True)

    slices = sliced.groupBy(*group_cols, "_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid") if group_cols \
        else Window.orderBy("_pid")  # one row per slice: at most #partitions rows
    slices = slices.withColumn(
        "_off", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    if size_col:
        wg = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
        slices = slices.withColumn(size_col, F.sum("_n").over(wg))
    slices = slices.drop("_n")
    # the slice table has at most (partitions + groups) rows; the planner's
    # size check decides between broadcast and shuffle join
    out = inner_null_safe(sliced, slices, [*group_cols, "_pid"])  # a null group is a group
    out = out.withColumn(rank_col, F.col("_off") + F.col("_pos") - F.col("_first") + 1)
    return out.drop("_pid", "_pos", "_first", "_off")


def ntile_from_rank(rank: Column, size: Column, n: int) -> Column:
    """SQL ntile(n) bucket from a 1-based rank and the partition size.

    The first (size mod n) buckets hold one extra row, as in Spark and DuckDB.
    """
    q = F.floor(size / F.lit(n))
    rem = size - q * F.lit(n)
    big = rem * (q + 1)
    in_big = F.floor((rank - 1) / (q + 1)) + 1
    in_small = rem + F.floor((rank - big - 1) / q) + 1
    return F.when(rank <= big, in_big).otherwise(in_small).cast("int")


def ntile(df: DataFrame, n: int, value_col: str, tiebreak: list[str],
          group_cols: list[str] | None = None, out_col: str = "ntile",
          descending: bool = False) -> DataFrame:
    """N12 + W9/W10: ntile over non-null ``value_col``; null values get null.

    Nulls are neither ranked nor counted, as ``dplyr::ntile`` does.

    Only the keys are ranked: rows with equal (group, value, tie-break) are one
    counted key, the keys' counts are added up over slices of their sorted
    order, and the first rank of a key is joined back to its rows.  Nothing but
    keys is written or range-sorted, however wide the table is.
    """
    keys = [*(group_cols or []), value_col, *tiebreak]
    keys = list(dict.fromkeys(keys))
    ranked = key_ranks(df.filter(F.col(value_col).isNotNull()), value_col, tiebreak, list(group_cols or []), descending)
    renamed = ranked.select(*[F.col(c).alias(f"_k_{c}") for c in keys], "_first", "_sz", "_n")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    out = df.join(renamed, same, "left").drop(*[f"_k_{c}" for c in keys])
    place = F.lit(0)
    if not ranked.filter("_n > 1").isEmpty():
        # rows alike in all keys share the ranks first .. first + n - 1
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) - 1
    return out.withColumn(out_col, ntile_from_rank(F.col("_first") + place, F.col("_sz"), n)) \
        .drop("_first", "_sz", "_n")


def key_ranks(df: DataFrame, value_col: str, tiebreak: list[str], group_cols: list[str],
              descending: bool = False) -> DataFrame:
    """Distinct (group, value, tie-break) with ``_n`` rows, the 1-based rank
    ``_first`` of the first of them in the group, and the group's rows ``_sz``."""
    keys = list(dict.fromkeys([*group_cols, value_col, *tiebreak]))
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_ord", -F.col(value_col) if descending else F.col(value_col))
    order = ["_ord", *tiebreak]
    sliced = counts.repartitionByRange(*group_cols, *order) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    slices = sliced.groupBy(*group_cols, "_pid").agg(F.sum("_n").alias("_m"))
    before = Window.partitionBy(*group_cols).orderBy("_pid") if group_cols else Window.orderBy("_pid")
    slices = slices.select(*group_cols, "_pid", (F.sum("_m").over(before) - F.col("_m")).alias("_off"),
                           F.sum("_m").over(Window.partitionBy(*group_cols)).alias("_sz"))
    upto = Window.partitionBy(*group_cols, "_pid").orderBy(*order)
    placed = inner_null_safe(sliced.withColumn("_upto", F.sum("_n").over(upto)), slices, [*group_cols, "_pid"])
    return placed.withColumn("_first", F.col("_off") + F.col("_upto") - F.col("_n") + 1) \
        .drop("_ord", "_pid", "_off", "_upto")


def quantiles(df: DataFrame, value_col: str, probs: list[float],
              group_cols: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """Exact type-7 quantiles (linear interpolation), per group.

    h = (n - 1) p + 1; q = x[floor h] + (h - floor h)(x[floor h + 1] - x[floor h]).
    Equal values are counted first (combined map-side), so a value held by most
    rows is one row; running totals over slices of the sorted distinct values
    then tell which values stand at the needed ranks.
    """
    group_cols = list(group_cols or [])
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.filter(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col) \
        .agg(F.count(F.lit(1)).alias("_n"))
    sliced = counts.repartitionByRange(*group_cols, value_col) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    within = Window.partitionBy(*group_cols, "_pid").orderBy(value_col)
    slices = sliced.groupBy(*group_cols, "_pid").agg(F.sum("_n").alias("_m"))
    before = Window.partitionBy(*group_cols).orderBy("_pid") if group_cols else Window.orderBy("_pid")
    slices = slices.select(
        *group_cols, "_pid",
        (F.sum("_m").over(before) - F.col("_m")).alias("_off"),
        F.sum("_m").over(Window.partitionBy(*group_cols)).alias("_sz"))
    placed = inner_null_safe(sliced.withColumn("_upto", F.sum("_n").over(within)), slices,
                             [*group_cols, "_pid"]) \
        .withColumn("_last", F.col("_off") + F.col("_upto"))

    def rank_of(p: float) -> Column:
        return (F.col("_sz") - 1) * F.lit(float(p)) + 1

    def at(rank: Column) -> Column:
        here = (rank > F.col("_last") - F.col("_n")) & (rank <= F.col("_last"))
        return F.max(F.when(here, F.col(value_col)))

    found = placed.groupBy(*group_cols).agg(
        F.max("_sz").alias("_sz"),
        *[at(F.floor(rank_of(p))).alias(f"_lo{i}") for i, p in enumerate(probs)],
        *[at(F.least(F.floor(rank_of(p)) + 1, F.col("_sz"))).alias(f"_hi{i}")
          for i, p in enumerate(probs)])
    return found.select(*group_cols, *[
        (F.col(f"_lo{i}") + (rank_of(p) - F.floor(rank_of(p))) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
        .alias(nm) for i, (nm, p) in enumerate(zip(names, probs))])
