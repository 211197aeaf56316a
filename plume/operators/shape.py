"""Column shaping, reshape and row-set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --- projection by name range / position / prefix / reorder ------------------

def cols_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Dplyr ``select(first:last)`` - names in column order, inclusive."""
    names = df.columns
    i, j = names.index(first), names.index(last)
    return names[i:j + 1]


def cols_slice(df: DataFrame, start: int, stop: int) -> list[str]:
    """``select(start:stop)`` with 1-based inclusive positions."""
    return df.columns[start - 1:stop]


def starts_with(df: DataFrame, prefix: str) -> list[str]:
    """P5."""
    return [c for c in df.columns if c.startswith(prefix)]


def front(df: DataFrame, *keys: str) -> DataFrame:
    """``select(keys, everything())``."""
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def one_hot(df: DataFrame, col: str, levels, name: str = "{col}_{level}") -> DataFrame:
    """0/1 column per level in one projection; NA stays NA."""
    c = F.col(col)
    return df.withColumns({
        name.format(col=col, level=lv): F.when(c == F.lit(lv), F.lit(1)).when(c != F.lit(lv), F.lit(0))
        for lv in levels
    })


def preview(df: DataFrame, start: int, stop: int, n: int = 10) -> DataFrame:
    """P4 + O2: columns start..stop (1-based) of the first ``n`` rows, as the
    notebooks page through a wide panel.  A display helper: the limit is the
    feature here."""
    return df.select(*cols_slice(df, start, stop)).limit(n)


def arrange(df: DataFrame, *keys: str) -> DataFrame:
    """O1: dplyr ``arrange`` with NA last (N11); used only at sinks, since
    row order means nothing to later stages."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


# --- reshape -----------------------------------------------------------------

def pivot_wide(df: DataFrame, ids: list[str], key: str, value: str, levels: list,
               agg=F.first) -> DataFrame:
    """Tidyr::spread with a fixed level list (no extra distinct job)."""
    return df.groupBy(*ids).pivot(key, levels).agg(agg(F.col(value)))


def unpivot_long(df: DataFrame, ids: list[str], cols: list[str], key: str = "key",
                 value: str = "value", cast: str | None = "double") -> DataFrame:
    """R2: tidyr::gather (one output row per id row and column)."""
    src = df.select(*ids, *[F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in cols])
    return src.unpivot(ids, cols, key, value)


def date_spine(keys: DataFrame, start: str, end: str, date_col: str = "date",
               distinct: bool = True) -> DataFrame:
    """Every day from ``start`` to ``end`` for each (distinct) key row.

    The sequence is generated inside each task from the key row, so the spine
    is as distributed as the keys.  With ``distinct=False`` every input row
    gets the days, which equals "distinct keys x days, left join the rows"
    (including its fan-out on repeated keys) without the join.
    """
    base = keys.distinct() if distinct else keys
    return base.withColumn(
        date_col,
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                             F.expr("interval 1 day"))))


def explode_daily_array(df: DataFrame, text_col: str, start_col: str,
                        date_col: str = "date", value_col: str = "visits") -> DataFrame:
    """R4: '[n1,...,n7]' text to one row per day: date = start + position."""
    arr = F.from_json(F.col(text_col), "array<int>")
    out = df.select("*", F.posexplode(arr).alias("_pos", value_col))
    return out.withColumn(date_col, F.date_add(F.col(start_col), F.col("_pos"))) \
        .drop("_pos", text_col)


# --- row sets ------------------------------------------------------------------

def union_all(dfs: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Rbind / bind_rows by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def append_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """add_row - union with a small literal or 1-row aggregate frame."""
    return df.unionByName(rows.select(*[F.col(c).cast(df.schema[c].dataType) if c in rows.columns
                                        else F.lit(None).cast(df.schema[c].dataType).alias(c)
                                        for c in df.columns]))


def replace_rows(df: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    """U4: drop the rows whose keys appear in ``patch``, then add ``patch``."""
    kept = df.join(patch.select(*keys).distinct(), on=keys, how="left_anti")
    return append_rows(kept, patch)
