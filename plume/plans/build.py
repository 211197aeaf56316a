"""Analytic panels (D10-D13): left-join chains of the cleaned sources.

Every right side is one row per key by construction (county or
county-period grain, ~3.1k counties x weeks), so the planner broadcasts it
while it fits the size threshold and shuffles otherwise; with
``check_unique`` each right side is asserted unique first (K10) so the left
row count is kept.  Keys match NA to NA as in R (N8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.functions import rsem
from plume.operators import joins, rank, shape
from plume.operators.aggregate import column_profile
from plume.session import ensure_checkpoint_dir

_DROP_WEEKLY = ["state_sip_start_date", "state_sip_end_date", "county_sip_start_date",
                "county_sip_end_date", "mean_cases", "mean_deaths"]


def _finish(panel: DataFrame, ids: list[str], order_key: list[str], drop: list[str]) -> DataFrame:
    """P2/P6 + F3 + M7 + W9: drop helper columns, ids first, keep rows with a
    vote share, add the >= .5 split and the vote-share percentile.

    The merged rows are written once to the shared checkpoint folder: the
    percentile reads them twice (keys, then rows), and each reading would
    otherwise run every source stage again."""
    out = shape.front(panel.drop(*drop), *ids)
    ensure_checkpoint_dir(out.sparkSession)
    out = out.filter(F.col("trump_vote_share").isNotNull()).checkpoint()
    out = out.withColumn("county_republican",
                         rsem.r_ifelse(F.col("trump_vote_share") >= 0.5, 1, 0))
    return rank.ntile(out, 100, "trump_vote_share", order_key, out_col="republican_vtsh_ntile")


def panel_weekly(poi: DataFrame, distancing_weekly: DataFrame, census: DataFrame,
                 weather_weekly: DataFrame, orders_weekly: DataFrame, cases_weekly: DataFrame,
                 votes: DataFrame, check_unique: bool = False) -> DataFrame:
    """The full county-week panel (47 columns, order of survey 1.3)."""
    wk = ["county_fips", "week_start_date"]
    merged = joins.chain(poi, [
        (distancing_weekly, wk),
        (census, ["county_fips", "state", "county"]),
        (weather_weekly, wk),
        (orders_weekly, [*wk, "state", "county"]),
        (cases_weekly, [*wk, "state", "county"]),
        (votes.select("county_fips", "trump_vote_share"), ["county_fips"]),
    ], check_unique=check_unique, null_keys=True)
    return _finish(merged, ["state", "county", "county_fips", "week_start_date"], wk, _DROP_WEEKLY)


def panel_distancing_weekly(distancing_weekly: DataFrame, census: DataFrame,
                            weather_weekly: DataFrame, orders_weekly: DataFrame,
                            cases_weekly: DataFrame, votes: DataFrame,
                            check_unique: bool = False) -> DataFrame:
    """Distancing-only weekly panel (names come from the census join)."""
    wk = ["county_fips", "week_start_date"]
    merged = joins.chain(distancing_weekly, [
        (census, ["county_fips"]),
        (weather_weekly, wk),
        (orders_weekly, [*wk, "state", "county"]),
        (cases_weekly, [*wk, "state", "county"]),
        (votes.select("county_fips", "trump_vote_share"), ["county_fips"]),
    ], check_unique=check_unique, null_keys=True)
    return _finish(merged, ["state", "county", "county_fips", "week_start_date"], wk, _DROP_WEEKLY)


def panel_daily(distancing_daily: DataFrame, census: DataFrame, weather_daily: DataFrame,
                orders_daily: DataFrame, cases_daily: DataFrame, votes: DataFrame,
                check_unique: bool = False, state: str = "illinois") -> dict[str, DataFrame]:
    """County-day panel and its one-state subset."""
    dy = ["county_fips", "date"]
    merged = joins.chain(distancing_daily, [
        (census, ["county_fips"]),
        (weather_daily, dy),
        (orders_daily, [*dy, "state", "county"]),
        (cases_daily, [*dy, "state", "county"]),
        (votes.select("county_fips", "trump_vote_share"), ["county_fips"]),
    ], check_unique=check_unique, null_keys=True)
    out = _finish(merged, ["state", "county", "county_fips", "date"], dy, _DROP_WEEKLY[:4])
    return {"daily": out, "one_state": one_state(out, state)}


def one_state(panel_daily_df: DataFrame, state: str) -> DataFrame:
    return panel_daily_df.filter((F.col("state") == state) & F.col("state_sip").isNotNull())


def votes_with_attributes(votes: DataFrame, attributes: DataFrame, drop_state: str = "02") -> DataFrame:
    """County votes joined to the county attribute table."""
    v = votes.filter(F.col("state_fips") != drop_state)
    a = attributes.filter(F.col("STATEFP10") != drop_state)
    return joins.join_renamed(v, a, {"county_fips": "GEOID10"})


def coverage_report(panel: DataFrame, numeric_only: bool = True) -> DataFrame:
    """Per-column summary and null share of a built panel."""
    kinds = dict(panel.dtypes)
    cols = [c for c in panel.columns
            if not numeric_only or kinds[c] in ("int", "bigint", "double", "float")]
    return column_profile(panel, cols)
