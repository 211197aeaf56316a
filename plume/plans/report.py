"""Analysis outputs (D14-D17): event-study estimates, trend series by partisan
group, map deciles.  Charts themselves are not built; these are the tables
they plot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.functions.rsem import sum_skip
from plume.operators import rank, shape, window
from plume.stats import event_study as es

BASE_WEEK = "2020-01-27"
OUTCOMES = ["total_visits", "total_visitors_diff_cbg", "devices_leaving_home",
            "median_non_home_dwell_time"]


# --- D14 -------------------------------------------------------------------------

def weeks_since(panel: DataFrame, flag: str = "weekly_sipo_binary") -> DataFrame:
    """W13/W14 on the weekly panel (rows with null ids dropped first, F3)."""
    clean = panel.filter(F.col("county_fips").isNotNull() & F.col("week_start_date").isNotNull())
    return window.event_time(clean, flag, "county_fips", "week_start_date")


def with_controls(panel: DataFrame, outcome: str) -> DataFrame:
    """W10 deciles of cases and deaths within each week, lags/leads of the
    outcome (W1/W2) and the decile dummies (P9)."""
    x = rank.ntile(panel, 10, "log_cases", ["county_fips"], ["week_start_date"], "cases_decile")
    x = rank.ntile(x, 10, "log_deaths", ["county_fips"], ["week_start_date"], "deaths_decile")
    x = window.lags_leads(x, outcome, "county_fips", "week_start_date")
    x = shape.one_hot(x, "cases_decile", range(1, 11))
    return shape.one_hot(x, "deaths_decile", range(1, 11))


def control_names(df: DataFrame) -> list[str]:
    """The reference's regressor ranges, by name (P3), in column order."""
    names = shape.cols_between(df, "share_asian", "mean_tmax") + \
        shape.cols_between(df, "weekly_sipo_binary", "log_pop_density")
    return names + [f"cases_decile_{i}" for i in range(1, 11)] + \
        [f"deaths_decile_{i}" for i in range(1, 11)]


LAGS = ["lag1", "lag2", "lead1", "lead2"]


def event_study(spark: SparkSession, panel: DataFrame, outcome: str = "log_total_visits",
                rows: tuple[int, int] | None = None) -> DataFrame:
    """{start, end} x {plain, controls, controls + lags/leads}.

    ``trump_vote_share`` is constant within a county and is swept out by the
    county effects (E11), as in the reference; its coefficient is reported
    dropped, and the partisan contrast is read off the event-week terms.
    """
    x = with_controls(weeks_since(panel), outcome)
    ctl = ["trump_vote_share", *control_names(x)]
    specs = []
    for ev in ("weeks_since_start", "weeks_since_end"):
        tag = ev.rsplit("_", 1)[1]
        specs += [es.Spec(f"{tag}_plain", outcome, ev, ["trump_vote_share"]),
                  es.Spec(f"{tag}_controls", outcome, ev, ctl),
                  es.Spec(f"{tag}_lags", outcome, ev, [*ctl, *LAGS])]
    return es.sweep(spark, x, specs, "county_fips", keep_rows=rows)


# --- D15 -------------------------------------------------------------------------

def partisan_trends(panel: DataFrame, base: str = BASE_WEEK) -> DataFrame:
    """Mean outcomes by above/below-median vote share and week, relative to the
    group's base week (M7, W12)."""
    med = rank.quantiles(panel, "trump_vote_share", [0.5], names=["m"]).collect()[0]["m"]
    x = panel.withColumn("republican", F.when(F.col("trump_vote_share") > F.lit(med), 1)
                         .when(F.col("trump_vote_share") <= F.lit(med), 0))
    return window.group_base_index(x, OUTCOMES, ["republican"], "week_start_date",
                                   F.to_date(F.lit(base)), suffix="_adj")


def partisan_cases_long(panel: DataFrame) -> DataFrame:
    """Total cases and deaths by group and week (H2 back-transform), long (R2)."""
    med = rank.quantiles(panel, "trump_vote_share", [0.5], names=["m"]).collect()[0]["m"]
    x = panel.withColumns({
        "republican": F.when(F.col("trump_vote_share") > F.lit(med), 1)
        .when(F.col("trump_vote_share") <= F.lit(med), 0),
        "cases": F.expm1("log_cases"), "deaths": F.expm1("log_deaths")})
    g = x.groupBy("republican", "week_start_date").agg(
        sum_skip("cases", real=True).alias("total_cases"),
        sum_skip("deaths", real=True).alias("total_deaths"))
    return shape.unpivot_long(g, ["republican", "week_start_date"], ["total_cases", "total_deaths"],
                              "measure", "count")


# --- D16 -------------------------------------------------------------------------

def map_deciles(panel: DataFrame, event_col: str = "weeks_since_start", base_week: int = -8,
                value: str = "total_visits", state: str | None = None) -> DataFrame:
    """Visits relative to the event-week base (down-only fill, M2) and their
    decile over all counties and weeks (W9, N12).  The reference computes the
    deciles over every state (K16); ``state`` restricts first."""
    x = weeks_since(panel)
    if state:
        x = x.filter(F.col("state") == state)
    x = x.filter(F.col(event_col).isNotNull())
    x = window.base_index(x, value, event_col, base_week, "county_fips",
                          order=[event_col, "week_start_date"], out_col="adj_visits")
    x = x.select("county_fips", "state", "week_start_date", event_col, value, "adj_visits")
    return rank.ntile(x, 10, "adj_visits", ["county_fips", "week_start_date"], out_col="decile")


def map_week(deciles: DataFrame, event_col: str, week: int) -> DataFrame:
    """One map: the counties' deciles at one event week."""
    return deciles.filter(F.col(event_col) == week).select(
        F.col("county_fips").alias("region"), F.col("decile").alias("value"))
