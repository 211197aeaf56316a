"""Public-health sources: cases and deaths (D5) and stay-home orders.

Both build a county x day spine (R5) from the order table's counties, so
their county-grain inputs are small (about 3.1k counties) and their daily
outputs grow with counties x days; the spine is generated inside tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.functions import calendar as cal
from plume.functions import rsem
from plume.functions import strings as st
from plume.operators import joins, policy, shape

# Fixed values (must equal the reference's) ---------------------------------------
SPINE_START, SPINE_END = "2020-01-27", "2020-05-31"
NYC_STATE = "New York"
NYC_COUNTY = "New York County"
NYC_FIPS = "36061"
NYC_BOROUGH_NAMES = ["New York County", "Kings County", "Queens County", "Richmond County",
                     "Bronx County"]
# Richmond County is 36085; the reference lists 36115 here (K6); compat keeps that
NYC_BOROUGH_FIPS = ["36005", "36047", "36061", "36081", "36085"]
NYC_BOROUGH_FIPS_COMPAT = ["36005", "36047", "36061", "36081", "36115"]
AREA_DROP_EXTRA = ["02230", "02275", "08014", "30113", "51780"]
MISSING_AREAS = [("02230", 1170.0), ("02275", 6620.0), ("08014", 85.48), ("02158", 44240.0),
                 ("11001", 158.1), ("36115", 2150.0), ("46102", 5420.0)]
SQ_MI_TO_KM = 2.58999
SENIOR_VARS = [f"s{i}" for i in range(1, 13)]   # ACS age cells 65+ (men s1-s6, women s7-s12)


def nyc_population(pop: DataFrame) -> DataFrame:
    """One-row total of the five borough populations, keyed by state."""
    boroughs = pop.filter((F.col("STNAME") == NYC_STATE) & F.col("CTYNAME").isin(NYC_BOROUGH_NAMES))
    # select first: column names resolve case-insensitively (STATE vs state)
    return joins.scalar_by_key(boroughs.select(F.col("STNAME").alias("state"), "POPESTIMATE2019"),
                               ["state"], rsem.sum_strict("POPESTIMATE2019"), "nyc_pop")


def _orders_fixed(orders: DataFrame, pop: DataFrame, keep_dates: bool) -> DataFrame:
    """County order rows with padded codes, the four other boroughs dropped and
    New York County's population replaced by the five-borough total (U4, J6)."""
    x = orders.withColumns({"state_fips": rsem.zpad("state_code", 2),
                            "county_fips": rsem.zpad("county_code", 3)})
    drop = ["citation1", "citation2", "citation3", "citation4", "citation5",
            "state_code", "county_code", "state"]
    if not keep_dates:
        drop += ["state_sip_start_date", "state_sip_end_date",
                 "county_sip_start_date", "county_sip_end_date"]
    x = x.drop(*drop).withColumnsRenamed({"state_name": "state", "county_name": "county"})
    others = [c for c in NYC_BOROUGH_NAMES if c != NYC_COUNTY]
    # same three-valued filter as R: a null condition drops the row
    x = x.filter(~((F.col("state") == NYC_STATE) & F.col("county").isin(others)))
    x = x.join(nyc_population(pop), "state", "left")
    is_nyc = (F.col("state") == NYC_STATE) & (F.col("county") == NYC_COUNTY)
    x = x.withColumn("popestimate2019", rsem.r_ifelse(is_nyc, F.col("nyc_pop"),
                                                      F.col("popestimate2019")))
    return x.drop("nyc_pop")


def _clean_names(df: DataFrame) -> DataFrame:
    return df.withColumns({"state": F.lower("state"), "county": st.clean_county("county")})


# --- D5 ------------------------------------------------------------------------

def county_area(spark: SparkSession, area: DataFrame, compat: bool = False) -> DataFrame:
    """km^2 per county with the boroughs merged and known gaps patched (U4)."""
    boroughs = NYC_BOROUGH_FIPS_COMPAT if compat else NYC_BOROUGH_FIPS
    size = area.filter(F.col("Areaname").contains(",")).select(
        F.col("STCOU").alias("county_fips"), (F.col("LND110200D") * SQ_MI_TO_KM).alias("km_sq"))
    nyc = size.filter(F.col("county_fips").isin(boroughs)) \
        .groupBy(F.lit(NYC_FIPS).alias("county_fips")).agg(rsem.sum_strict("km_sq").alias("km_sq"))
    missing = spark.createDataFrame(MISSING_AREAS, "county_fips string, km_sq double")
    kept = size.filter(~F.col("county_fips").isin(boroughs + AREA_DROP_EXTRA))
    # a patched county may be in the table already (36115 by default): one row each
    return shape.replace_rows(shape.union_all([kept, nyc]), missing, ["county_fips"])


def senior_share(acs: DataFrame, compat: bool = False) -> DataFrame:
    """share_over_65 per county from the long ACS table (R1 + H11), boroughs merged."""
    boroughs = NYC_BOROUGH_FIPS_COMPAT if compat else NYC_BOROUGH_FIPS
    wide = shape.pivot_wide(acs, ["GEOID", "NAME"], "variable", "estimate", ["total", *SENIOR_VARS])
    wide = wide.withColumn("seniors", rsem.row_sum(*SENIOR_VARS)) \
        .withColumnRenamed("GEOID", "county_fips")
    nyc = wide.filter(F.col("county_fips").isin(boroughs)).groupBy(
        F.lit(NYC_FIPS).alias("county_fips")).agg(
        rsem.sum_strict("total").alias("total"), rsem.sum_strict("seniors").alias("seniors"))
    rest = wide.filter(~F.col("county_fips").isin(boroughs)).select("county_fips", "total", "seniors")
    out = shape.union_all([rest, nyc])
    return out.select("county_fips", rsem.safe_div("seniors", "total").alias("share_over_65"))


def nyt_county(cases: DataFrame) -> DataFrame:
    """NYT rows keyed by FIPS with New York City mapped to New York County.

    Rows without FIPS get a null key (R pastes "NANA"); neither matches."""
    is_city = F.col("county") == "New York City"
    county = F.when(is_city, F.lit(NYC_COUNTY)).otherwise(F.col("county"))
    fips = F.when(county == NYC_COUNTY, F.lit(NYC_FIPS)).otherwise(F.col("fips"))
    return cases.select("date", F.concat(F.substring(fips, 1, 2), F.substring(fips, 3, 3))
                        .alias("county_fips"), "cases", "deaths")


def cases(spark: SparkSession, nyt: DataFrame, orders: DataFrame, pop: DataFrame,
          area: DataFrame, acs: DataFrame, compat: bool = False,
          start: str = SPINE_START, end: str = SPINE_END) -> dict[str, DataFrame]:
    """County-day cases/deaths on the order-table spine, with density and
    age, then weekly means of the cumulative counts and their logs (M10)."""
    fixed = _orders_fixed(orders, pop, keep_dates=False)
    keys = fixed.select("state_fips", "county_fips", "state", "county", "popestimate2019")
    spine = shape.date_spine(keys, start, end, "date")
    spine = spine.withColumn("county_fips", F.concat("state_fips", "county_fips")).drop("state_fips")
    spine = _clean_names(spine)
    daily = spine.join(nyt_county(nyt), ["county_fips", "date"], "left") \
        .join(senior_share(acs, compat), "county_fips", "left") \
        .join(county_area(spark, area, compat), "county_fips", "left")
    daily = daily.withColumns({"cases": F.coalesce("cases", F.lit(0)),
                               "deaths": F.coalesce("deaths", F.lit(0))})
    daily = daily.withColumns({
        "log_cases": rsem.log1p("cases"), "log_deaths": rsem.log1p("deaths"),
        "log_pop_density": rsem.log1p(rsem.safe_div("popestimate2019", "km_sq"))})
    daily = daily.select("county_fips", "date", "state", "county", "popestimate2019", "cases",
                         "deaths", "share_over_65", "km_sq", "log_cases", "log_deaths",
                         "log_pop_density")
    weekly = daily.withColumn("week_start_date", cal.week_start("date")).groupBy(
        "county_fips", "state", "county", "week_start_date", "share_over_65", "log_pop_density"
    ).agg(rsem.mean_skip("cases").alias("mean_cases"), rsem.mean_skip("deaths").alias("mean_deaths"))
    weekly = weekly.withColumns({"log_cases": rsem.log1p("mean_cases"),
                                 "log_deaths": rsem.log1p("mean_deaths")})
    return {"daily": daily, "weekly": weekly}


# --- D6 ------------------------------------------------------------------------

_DATE_COLS = ["state_sip_start_date", "state_sip_end_date",
              "county_sip_start_date", "county_sip_end_date"]


def orders(county_orders: DataFrame, pop: DataFrame, start: str = SPINE_START,
           end: str = SPINE_END) -> dict[str, DataFrame]:
    """Daily state/county/any order flags on the county spine (M5) and
    weekly order days and any-day flag (M6)."""
    fixed = _orders_fixed(county_orders, pop, keep_dates=True).drop("popestimate2019")
    # the reference joins the order rows back onto a spine of their own distinct
    # keys; exploding the days on the rows themselves is the same, without a join
    daily = shape.date_spine(fixed, start, end, "date", distinct=False)
    daily = daily.withColumns({c: cal.parse_date(c, cal.US_SLASH) for c in _DATE_COLS})
    daily = policy.daily_flags(daily, "date")
    daily = daily.withColumn("county_fips", F.concat("state_fips", "county_fips"))
    daily = _clean_names(daily).drop("state_fips")
    daily = daily.select("county_fips", "state", "county", "date", *_DATE_COLS,
                         "state_sip", "county_sip", "sip_binary")
    weekly = policy.weekly_days(daily, ["county_fips", "state", "county"], "date",
                                carry=_DATE_COLS)
    weekly = weekly.select("county_fips", "state", "county", "week_start_date", *_DATE_COLS,
                           "sip_days", "weekly_sipo_binary")
    return {"daily": daily, "weekly": weekly}


def state_order_dates(daily_orders: DataFrame, state: str) -> DataFrame:
    """The distinct order dates of one state's counties."""
    return daily_orders.filter(F.col("state") == state).select(
        "county_fips", *_DATE_COLS).distinct()
