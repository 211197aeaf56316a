"""String scalars (X1-X10) and the R ``separate`` split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.functions.rsem import zpad  # noqa: F401  (X1, re-exported)

ColLike = Column | str

# Fixed value: tidyr::separate's default separator, a run of non-alphanumerics.
SEPARATE_DEFAULT = "[^0-9A-Za-z]+"


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def str_sub(x: ColLike, start: int, end: int | None = None) -> Column:
    """Stringr::str_sub with 1-based, inclusive, possibly negative bounds."""
    s = _c(x).cast("string")
    n = F.length(s)
    st = F.lit(start) if start > 0 else n + F.lit(start + 1)
    if end is None:
        en = n
    else:
        en = F.lit(end) if end > 0 else n + F.lit(end + 1)
    st = F.greatest(st, F.lit(1))
    length = F.greatest(en - st + 1, F.lit(0))
    return s.substr(st, length)


def clean_county(x: ColLike) -> Column:
    """Trim, drop the ' County' suffix, lower-case."""
    return F.lower(F.trim(F.replace(_c(x), F.lit(" County"), F.lit(""))))


def before_first(x: ColLike, sep: str) -> Column:
    """strsplit(x, sep)[1]."""
    return F.substring_index(_c(x), sep, 1)


def separate(df: DataFrame, col: str, into: list[str], sep: str = SEPARATE_DEFAULT,
             drop: bool = True) -> DataFrame:
    """Tidyr::separate. Extra pieces are dropped, missing pieces are null;
    an empty input gives '' then nulls, as in R."""
    parts = F.split(F.col(col), sep)
    cols = {}
    for i, name in enumerate(into, start=1):
        piece = F.try_element_at(parts, F.lit(i))
        cols[name] = piece
    out = df.withColumns(cols)
    return out.drop(col) if drop and col not in into else out


def json_first_entry(x: ColLike, value_type: str = "int") -> tuple[Column, Column]:
    """First key and value of a JSON object text, order kept.

    An empty or unparseable object gives (null, null).
    """
    m = F.from_json(_c(x), f"map<string,{value_type}>")
    return (F.try_element_at(F.map_keys(m), F.lit(1)),
            F.try_element_at(F.map_values(m), F.lit(1)))


def json_lookup(x: ColLike, key: ColLike, value_type: str = "int") -> Column:
    """M4 'lookup' mode: the value stored under the POI's own key, if any."""
    m = F.from_json(_c(x), f"map<string,{value_type}>")
    return F.try_element_at(m, _c(key))
