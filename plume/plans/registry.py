"""Registry of driver queries: name -> (spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plume.plans import raw_side
from plume.plans import standins as s
from plume.plans.oracle import oracle_sql as _oracle
from plume.plans.oracle_fits import fit_oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_event_panel": s.flagship_event_panel,
    "daily_rollup": s.daily_rollup,
    "weekly_rollup": s.weekly_rollup,
    "week_of_year_label": s.week_of_year_label,
    "date_spine_fill": s.date_spine_fill,
    "two_grain_counts": s.two_grain_counts,
    "weighted_mean_joinback": s.weighted_mean_joinback,
    "mean_of_ratios_vs_ratio_of_sums": s.mean_of_ratios_vs_ratio_of_sums,
    "strict_sum_nulls": s.strict_sum_nulls,
    "skip_sum_nulls": s.skip_sum_nulls,
    "null_group": s.null_group,
    "null_safe_left_join": s.null_safe_left_join,
    "fips_pad_key": s.fips_pad_key,
    "clean_names": s.clean_names,
    "pivot_long_to_wide": s.pivot_long_to_wide,
    "unpivot_wide_to_long": s.unpivot_wide_to_long,
    "json_map_first": s.json_map_first,
    "array_explode_days": s.array_explode_days,
    "coverage_filter": s.coverage_filter,
    "ever_treated_semi": s.ever_treated_semi,
    "scalar_override": s.scalar_override,
    "policy_interval_flag": s.policy_interval_flag,
    "policy_weekly_days": s.policy_weekly_days,
    "star_left_chain": s.star_left_chain,
    "renamed_key_inner": s.renamed_key_inner,
    "point_in_rect": s.point_in_rect,
    "point_in_polygon": s.point_in_polygon,
    "lags_leads": s.lags_leads,
    "fill_down": s.fill_down,
    "fill_up": s.fill_up,
    "fill_both": s.fill_both,
    "event_time": s.event_time,
    "base_week_index": s.base_week_index,
    "event_base_index": s.event_base_index,
    "ntile_partitioned": s.ntile_partitioned,
    "ntile_null_group": s.ntile_null_group,
    "ntile_global": s.ntile_global,
    "decile_one_hot": s.decile_one_hot,
    "quantile_gap": s.quantile_gap,
    "median_split_trend": s.median_split_trend,
    "attrition_share": s.attrition_share,
    "column_profile": s.column_profile,
    "log_transforms": s.log_transforms,
    "ols_pooled": s.ols_pooled,
    "within_fe": s.within_fe,
    "cluster_se": s.cluster_se,
    "two_way_fe": s.two_way_fe,
    "two_way_fe_unbalanced": s.two_way_fe_unbalanced,
    "weekly_slope_sweep": s.weekly_slope_sweep,
    "welch_ci": s.welch_ci,
    "welch_ci_bounds": s.welch_ci_bounds,
    "event_study_table": s.event_study_table,
    "event_study_lags": s.event_study_lags,
    "distancing_daily_build": s.distancing_daily_build,
    "distancing_weekly_build": s.distancing_weekly_build,
    "poi_weekly_build": s.poi_weekly_build,
    "poi_weekly_naics_build": s.poi_weekly_naics_build,
    "poi_daily_build": s.poi_daily_build,
    "poi_daily_naics_build": s.poi_daily_naics_build,
    "orders_daily_build": s.orders_daily_build,
    "orders_weekly_build": s.orders_weekly_build,
    "cases_daily_build": s.cases_daily_build,
    "cases_weekly_build": s.cases_weekly_build,
    "panel_distancing_build": s.panel_distancing_build,
    "panel_weekly_build": s.panel_weekly_build,
    "panel_daily_build": s.panel_daily_build,
    "map_deciles_report": s.map_deciles_report,
    "map_week_report": s.map_week_report,
    "partisan_trends_report": s.partisan_trends_report,
    "event_study_report": s.event_study_report,
    "streaming_device_rollup": s.streaming_device_rollup,
    "votes_attributes_build": s.votes_attributes_build,
    "state_order_dates_report": s.state_order_dates_report,
    "snapshot_latest": s.snapshot_latest,
    **raw_side.QUERIES,
}


def oracle_sql() -> dict[str, str]:
    sql = {**_oracle(), **fit_oracles()}
    sql |= raw_side.oracles(sql)
    return {k: v for k, v in sql.items() if k in QUERIES}
