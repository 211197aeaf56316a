"""Window operators over an entity-period panel.

All windows here are partitioned by the entity and ordered by the period, and
are meant to run after the data has been aggregated to the entity-period grain:
one entity then holds at most one row per period, so even an entity with a
third of all raw rows cannot make a window partition larger than the calendar.
Global orderings (deciles over all rows) live in ``plume.operators.rank``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plume.functions.rsem import exact_mean


def _w(entity: list[str] | str, order: list[str] | str) -> Window:
    entity = [entity] if isinstance(entity, str) else list(entity)
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*entity).orderBy(*order)


def fill_down(x: str, entity, order) -> Column:
    """Tidyr::fill (down): last non-null at or before the row."""
    w = _w(entity, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(F.col(x), ignorenulls=True).over(w)


def fill_up(x: str, entity, order) -> Column:
    """fill(.direction = "up"): first non-null at or after the row."""
    w = _w(entity, order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.first(F.col(x), ignorenulls=True).over(w)


def fill_both(x: str, entity, order) -> Column:
    """Fill down, then fill the leading gap up."""
    return F.coalesce(fill_down(x, entity, order), fill_up(x, entity, order))


def fill(df: DataFrame, cols: list[str], entity, order, direction: str = "down") -> DataFrame:
    """Apply a fill to several columns in one projection."""
    fn = {"down": fill_down, "up": fill_up, "downup": fill_both}[direction]
    return df.withColumns({c: fn(c, entity, order) for c in cols})


def lags_leads(df: DataFrame, x: str, entity, order, lags=(1, 2, 3), leads=(1, 2, 3),
               lag_name: str = "lag{k}", lead_name: str = "lead{k}") -> DataFrame:
    """Dplyr lag/lead by row within the entity."""
    w = _w(entity, order)
    cols = {lag_name.format(k=k): F.lag(F.col(x), k).over(w) for k in lags}
    cols.update({lead_name.format(k=k): F.lead(F.col(x), k).over(w) for k in leads})
    return df.withColumns(cols)


def event_time(df: DataFrame, flag: str, entity, order,
               start_col: str = "weeks_since_start", end_col: str = "weeks_since_end",
               index_col: str | None = None) -> DataFrame:
    """Rows since the last 0->1 switch and since the last 1 before a 1->0.

    Row numbers count observed rows (not calendar periods), as the reference
    does.  Marker positions are filled down, then up (K18: with two spells the
    later start wins for the rows after it, the first start for rows before
    any start).  Entities with no transition get null event time (K19).
    """
    w = _w(entity, order)
    rn = F.row_number().over(w)
    f = F.col(flag)
    out = df.withColumn("_rn", rn).withColumns({
        "_s": F.when((f == 1) & (F.lag(f, 1).over(w) == 0), F.col("_rn")),
        "_e": F.when((f == 1) & (F.lead(f, 1).over(w) == 0), F.col("_rn")),
    })
    out = out.withColumns({"_s": fill_both("_s", entity, order),
                           "_e": fill_both("_e", entity, order)})
    out = out.withColumns({start_col: (F.col("_rn") - F.col("_s")).cast("int"),
                           end_col: (F.col("_rn") - F.col("_e")).cast("int")})
    if index_col:
        out = out.withColumnRenamed("_rn", index_col)
    else:
        out = out.drop("_rn")
    return out.drop("_s", "_e")


def base_index(df: DataFrame, x: str, t: str, base, entity, order=None,
               out_col: str = "index", causal: bool = True) -> DataFrame:
    """X divided by x at the base period of the same entity.

    ``causal`` reproduces the reference's down-only fill: rows ordered before
    the base row get null, and with several base rows the most recent one
    applies.  Division by zero gives null (N9).
    """
    order = order or t
    base_val = F.when(F.col(t) == F.lit(base), F.col(x))
    tmp = df.withColumn("_b", base_val)
    if causal:
        tmp = tmp.withColumn("_b", fill_down("_b", entity, order))
    else:
        tmp = tmp.withColumn("_b", fill_both("_b", entity, order))
    return tmp.withColumn(out_col, F.try_divide(F.col(x), F.col("_b"))).drop("_b")


def group_base_index(df: DataFrame, x_cols: list[str], group: list[str], t: str, base,
                     suffix: str = "_index") -> DataFrame:
    """Mean by (group, period) divided by the same group's base-period mean.

    Partitioned by the group, not by row order (K15); rows before the base
    period keep the base (the base period is the first one in the reference).
    """
    means = df.groupBy(*group, t).agg(*[exact_mean(c).alias(c) for c in x_cols])
    w = Window.partitionBy(*group)
    return means.withColumns({
        f"{c}{suffix}": F.try_divide(
            F.col(c), F.max(F.when(F.col(t) == F.lit(base), F.col(c))).over(w))
        for c in x_cols
    })
