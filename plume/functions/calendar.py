"""Date and calendar scalars.

All are plain column expressions, so a week label costs no sort and no
exchange (the reference derives it with a lead/row_number/fill sequence per
county).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed formats used by the sources (values must equal the reference's):
#   ISO "%Y-%m-%d", US "%m/%d/%Y", short "%m-%d-%y"
ISO = "yyyy-MM-dd"
US_SLASH = "M/d/yyyy"   # accepts one or two digit month/day, like R's %m/%d/%Y
SHORT_DASH = "M-d-yy"


def parse_date(x: ColLike, fmt: str = ISO) -> Column:
    """Parse text to a date; unparseable text gives null (R gives NA)."""
    return F.try_to_date(_c(x).cast("string"), fmt)


def iso_prefix_date(x: ColLike) -> Column:
    """Local date of an ISO timestamp text: its first 10 characters."""
    return parse_date(F.substring(_c(x).cast("string"), 1, 10), ISO)


def r_week(d: ColLike) -> Column:
    """Lubridate::week = (yday - 1) %/% 7 + 1 (not ISO weeks)."""
    return (F.floor((F.dayofyear(_c(d)) - 1) / 7) + 1).cast("int")


def week_start(d: ColLike) -> Column:
    """Monday on or before the date.

    Equals the reference's label (lubridate week of the date two days ahead,
    first day of each such week) whenever the year starts on a Wednesday, as
    2020 does; see ``shifted_week_key`` for other years.
    """
    # timestamp_ntz: no session time zone takes part in the truncation
    return F.to_date(F.date_trunc("week", _c(d).cast("timestamp_ntz")))


def shifted_week_key(d: ColLike, shift_days: int = 2) -> Column:
    """Year and lubridate week of ``d + shift_days``: the reference's grouping key.

    The label is then the first observed date within (entity, key), i.e.
    ``min(date)`` over that group.
    """
    ahead = F.date_add(_c(d), shift_days)
    return F.year(ahead) * 100 + r_week(ahead)


def as_of_label(as_of: str) -> Column:
    """T5: 'MM-DD' label of an explicit as-of date (never the wall clock)."""
    return F.date_format(F.to_date(F.lit(as_of)), "MM-dd")
