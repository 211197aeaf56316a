"""R-semantics column helpers (NULL rules N1-N15 of the survey).

Every stage uses these instead of the raw Spark function whenever the R code
it re-expresses would behave differently on NA, Inf or bad input.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColLike = Column | str


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ifelse(cond, a, b) keeps NA when cond is NA
def r_ifelse(cond: Column, yes, no) -> Column:
    yes_c = yes if isinstance(yes, Column) else F.lit(yes)
    no_c = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes_c).when(~cond, no_c)


# one billionth: the unit in which real-valued columns are added up
_UNIT = 1e9


def _fixed(x: Column) -> Column:
    """A finite double as a whole number of billionths (decimal, so sums can't
    overflow); values from 9e9 on, beyond a long in that unit, are cast."""
    scaled = x * F.lit(_UNIT)
    return F.when(F.abs(x) < F.lit(9e9), F.floor(scaled + F.lit(0.5)).cast("decimal(38,0)")) \
        .otherwise(F.round(scaled).try_cast("decimal(38,0)"))


def exact_sum(x: ColLike) -> Column:
    """Sum of a real-valued column that does not depend on the order of rows.

    Double additions round, so their total changes with partitioning and
    retries.  Here every value becomes a whole number of billionths, these are
    added as decimals (exactly) and the total is divided once.  Infinite and
    NaN values give infinity or NaN, as in a plain sum; nulls are skipped and
    a group without values gives null.
    """
    c = _c(x).cast("double")
    finite = F.abs(c) < F.lit(float("inf"))
    total = F.sum(F.when(finite, _fixed(c))).cast("double") / F.lit(_UNIT)
    return F.coalesce(F.sum(F.when(~finite, c)), total)


def exact_mean(x: ColLike) -> Column:
    """Mean of a real-valued column by ``exact_sum``; null for no values."""
    c = _c(x)
    return F.try_divide(exact_sum(c), F.count(c))


# sum(x, na.rm=TRUE); all-NA group gives 0.  ``real`` for real-valued
# columns (whole numbers add exactly anyway)
def sum_skip(x: ColLike, real: bool = False) -> Column:
    return F.coalesce(exact_sum(x), F.lit(0.0)) if real else F.coalesce(F.sum(_c(x)), F.lit(0))


# sum(x) without na.rm; any NA gives NA
def sum_strict(x: ColLike, real: bool = False) -> Column:
    c = _c(x)
    return F.when(F.count(c) == F.count(F.lit(1)), exact_sum(c) if real else F.sum(c))


# mean(x, na.rm=TRUE); NaN is dropped like NA, all-missing stays null
def mean_skip(x: ColLike) -> Column:
    c = _c(x)
    return exact_mean(F.when(~F.isnan(c), c))


# pmin(a, b) is NA if either is NA
def pmin(a: ColLike, b: ColLike) -> Column:
    a, b = _c(a), _c(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


# H5: clip below at zero, null stays null (not greatest(), which skips nulls)
def clip_low0(x: ColLike) -> Column:
    c = _c(x)
    return F.when(c < 0, F.lit(0)).otherwise(c)


# X / 0 is null instead of an ANSI error (R gives Inf / NaN)
def safe_div(a: ColLike, b: ColLike) -> Column:
    return F.try_divide(_c(a), _c(b))


# Failed cast is null instead of an ANSI error
def try_cast(x: ColLike, to: str) -> Column:
    return F.try_cast(_c(x), to) if hasattr(F, "try_cast") else _c(x).try_cast(to)


# str_pad(x, n, "left", "0") never truncates (Spark lpad does)
def zpad(x: ColLike, n: int) -> Column:
    s = _c(x).cast("string")
    return F.when(F.length(s) < n, F.lpad(s, n, "0")).otherwise(s)


# Row-wise sum, NA if any term is NA
def row_sum(*cols: ColLike) -> Column:
    return reduce(add, [_c(c) for c in cols])


# Share of nulls
def null_share(x: ColLike) -> Column:
    return F.avg(_c(x).isNull().cast("double"))


# H1: log(1 + x); null at x <= -1 (R gives -Inf / NaN)
def log1p(x: ColLike) -> Column:
    c = _c(x)
    return F.when(c > -1, F.log1p(c))


# A10: weighted mean with weights n / sum(n over all rows of the group)
def weighted_mean(n: ColLike, x: ColLike, strict: bool = True) -> Column:
    """One-pass sum(n*x)/sum(n).

    The denominator sums n over every row of the group, also where x is null,
    as the reference's join-back of the group total does.  ``strict`` keeps
    R's ``sum()`` (any missing product gives null, the daily rule);
    otherwise missing products are skipped and an all-missing group gives 0
    (``sum(na.rm=TRUE)``, the weekly rule).
    """
    n, x = _c(n), _c(x)
    prod = n * x
    num = sum_strict(prod, real=True) if strict else sum_skip(prod, real=True)
    return F.try_divide(num, F.sum(n))


def left_join_na(left: DataFrame, right: DataFrame, on: list[str],
                 how: str = "left") -> DataFrame:
    """R's join matches NA keys to NA keys; Spark's ``=`` does not.

    Uses null-safe equality and keeps one copy of each key column.
    """
    r = right
    renamed = {k: f"__r_{k}" for k in on}
    r = r.withColumnsRenamed(renamed)
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(r[renamed[k]]) for k in on])
    joined = left.join(r, cond, how)
    return joined.drop(*renamed.values())
