"""Which intervals hold at which points, as an equi-join.

``point BETWEEN start AND end`` has no key to deal rows by, so a plain plan
compares every point with every interval (of the same entity).  Here the time
line is cut into halves again and again; an interval is the union of a few
pieces of that scheme (at most two a level, none inside another), and a point
lies in one piece of every level.  Points and intervals meet where they name the
same piece, each true pair exactly once.

Open ends count as the ends of the points' own range.  An interval without both
ends, or whose start is after its end, holds nowhere.  Null points meet nothing;
null join keys match each other, as in R.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plume.operators.joins import inner_null_safe


def _number(df: DataFrame, col: str) -> Column:
    """Days since 1970 of a date column; whole numbers as they are."""
    c = F.col(col)
    return F.unix_date(c) if isinstance(df.schema[col].dataType, T.DateType) else c.cast("bigint")


def pieces(a: Column, b: Column, levels: int) -> Column:
    """The pieces of [a, b] (0 <= a, b < 2 ** levels) as (level, number)."""
    out = []
    for level in range(levels + 1):
        first = F.shiftright(a + F.lit((1 << level) - 1), level)
        past = F.shiftright(b + 1, level)
        at = F.lit(level)
        out += [F.when((first < past) & (first % 2 == 1), F.struct(at.alias("level"), first.alias("number"))),
                F.when((first < past) & (past % 2 == 1), F.struct(at.alias("level"), (past - 1).alias("number")))]
    return F.filter(F.array(*out), lambda p: p.isNotNull())


def range_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str,
               on: list[str] | None = None, sums: list[str] | None = None) -> DataFrame:
    """Inner join of ``points`` with the ``intervals`` that hold at ``point``,
    with equal ``on`` columns if given.  Other column names must differ.

    With ``sums``, whole-number columns of ``intervals`` that are only to be
    added up per point, the intervals naming a piece are added up before the
    join.  A row is then a point and one piece with the sums over all the
    intervals held there, not a point and one interval: at most one row a level
    and point, however many intervals overlap, and sums over the rows of a point
    equal those over its pairs.
    """
    on = list(on or [])
    low, high = points.agg(F.min(_number(points, point)), F.max(_number(points, point))).first()
    low, high = (0, 0) if low is None else (low, high)
    levels = (high - low).bit_length()
    a = F.greatest(F.coalesce(_number(intervals, start), F.lit(low)), F.lit(low)) - low
    b = F.least(F.coalesce(_number(intervals, end), F.lit(high)), F.lit(high)) - low
    some = F.col(start).isNotNull() | F.col(end).isNotNull()
    held = intervals.filter(some).withColumn("_a", a.cast("bigint")).withColumn("_b", b.cast("bigint")) \
        .filter("_a <= _b").withColumn("_piece", F.explode(pieces(F.col("_a"), F.col("_b"), levels))).drop("_a", "_b")
    if sums is not None:
        held = held.groupBy(*on, "_piece").agg(*[F.sum(c).alias(c) for c in sums])
    # a point need only name pieces of the levels that occur (at most 64 numbers)
    used = sorted(r[0] for r in held.select("_piece.level").distinct().collect())
    place = (_number(points, point) - low).cast("bigint")
    named = points.filter(F.col(point).isNotNull()).withColumn("_piece", F.explode(
        F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(place, k).alias("number")) for k in used])
        if used else F.array().cast("array<struct<level:int,number:bigint>>")))
    return inner_null_safe(named, held, [*on, "_piece"]).drop("_piece")


def times_in_force(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str,
                   on: list[str], out_col: str = "in_force") -> DataFrame:
    """Every row of ``points`` with the number of intervals that hold there.

    Counted once per distinct (keys, point), so rows of a busy day or of a hot
    key do not multiply with the intervals.
    """
    spots = points.select(*on, point).distinct()
    count = range_join(spots, intervals.select(*on, start, end), point, start, end, on) \
        .groupBy(*on, point).agg(F.count(F.lit(1)).alias(out_col))
    same = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*on, point]]
    renamed = count.select(*[F.col(c).alias(f"_c_{c}") for c in [*on, point]], out_col)
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return points.join(renamed, cond, "left").drop(*[f"_c_{c}" for c in [*on, point]]) \
        .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(0)).cast("bigint"))
