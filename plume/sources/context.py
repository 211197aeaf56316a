"""County context sources: weather (D7), census shares (D8), votes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.functions import calendar as cal
from plume.functions import rsem
from plume.functions import strings as st
from plume.operators import joins, shape

FIRST_WEEK = "2020-01-27"

# ACS variable names of the census build (as named in the long table)
ACS_REP_VARS = ["bachelors", "white", "black", "asian", "current_undergrad", "poverty",
                "hhinc_100k", "total"]
ACS_OCC_VARS = ["total_occupations", "msta", "services", "sales", "resources", "public_transit"]
# share name -> numerator, in the reference's creation order
POP_SHARES = [("share_asian", "asian"), ("share_black", "black"), ("share_white", "white"),
              ("share_bachelors", "bachelors"), ("share_undergrad", "current_undergrad"),
              ("share_hhinc_100k", "hhinc_100k"), ("share_poverty", "poverty")]
OCC_SHARES = [("share_msta", "msta"), ("share_services", "services"), ("share_sales", "sales"),
              ("share_resources", "resources"), ("share_public_transit", "public_transit")]
PRESIDENT = "US President"
TRUMP = "trump"


# --- D7 ------------------------------------------------------------------------

def weather(raw: DataFrame, first_week: str = FIRST_WEEK) -> dict[str, DataFrame]:
    """Daily county weather and Monday-week means.

    The reference shifts week numbers with an ungrouped lead, so the last two
    days of each county land in the next county's week (K1); here every day
    falls in its true week.
    """
    daily = raw.select(rsem.zpad(F.col("county").cast("string"), 5).alias("county_fips"),
                       cal.parse_date("date").alias("date"), "precip", "tmin", "tmax")
    weekly = daily.withColumn("week_start_date", cal.week_start("date")) \
        .filter(F.col("week_start_date") >= F.to_date(F.lit(first_week))) \
        .groupBy("county_fips", "week_start_date").agg(
            rsem.mean_skip("precip").alias("mean_precip"),
            rsem.mean_skip("tmin").alias("mean_tmin"),
            rsem.mean_skip("tmax").alias("mean_tmax"))
    return {"daily": daily, "weekly": weekly}


# --- D8 ------------------------------------------------------------------------

def census(acs: DataFrame, pop_2016: DataFrame) -> DataFrame:
    """county_fips, county, state and the 12 shares (7 population, 5 occupation)."""
    rep = shape.pivot_wide(acs, ["GEOID", "NAME"], "variable", "estimate", ACS_REP_VARS)
    occ = shape.pivot_wide(acs, ["GEOID", "NAME"], "variable", "estimate", ACS_OCC_VARS)
    occ = occ.select("GEOID", "NAME", *[rsem.safe_div(num, "total_occupations").alias(name)
                                        for name, num in OCC_SHARES])
    pop = pop_2016.select(F.trim(st.str_sub("county", 2, -1)).alias("NAME"), "population")
    out = joins.left_join(rep, pop, ["NAME"], null_keys=True)
    out = out.withColumns({name: rsem.safe_div(num, "population") for name, num in POP_SHARES})
    out = joins.left_join(out, occ, ["NAME", "GEOID"], null_keys=True)
    out = st.separate(out, "NAME", ["countyname", "statename"], sep=",")
    # the split leaves " Alabama"; the reference repairs it by a CSV round trip
    out = out.withColumns({"county": st.clean_county("countyname"),
                           "state": F.lower(F.trim("statename"))})
    out = out.withColumnRenamed("GEOID", "county_fips")
    return out.select("county_fips", "county", "state", *shape.starts_with(out, "share"))


# --- D9 ------------------------------------------------------------------------

def votes(precincts: DataFrame, filter_both: bool = False, check_unique: bool = False) -> DataFrame:
    """County vote share of the named candidate.

    The denominator keeps only presidential rows while the numerator does not
    (K9; ``filter_both`` filters both).  The numerator is also grouped by the
    county's coordinates, so a county with two coordinate pairs fans the join
    out (K10); ``check_unique`` fails loudly on that.
    """
    keys = ["state", "state_fips", "state_postal", "county_name", "county_fips"]
    tot = precincts.filter(F.col("office") == PRESIDENT).groupBy(*keys).agg(
        rsem.sum_skip("votes").alias("totvotes")) \
        .withColumn("county_fips", F.substring("county_fips", 1, 5))
    cand = precincts.filter(F.col("candidate_normalized") == TRUMP)
    if filter_both:
        cand = cand.filter(F.col("office") == PRESIDENT)
    cand = cand.groupBy(*keys, "county_lat", "county_long").agg(
        rsem.sum_skip("votes").alias("trump_votes")) \
        .withColumn("county_fips", F.substring("county_fips", 1, 5))
    out = joins.left_join(tot, cand, keys, null_keys=True, check_unique=check_unique,
                          name="candidate totals")
    out = out.withColumns({"trump_vote_share": rsem.safe_div("trump_votes", "totvotes"),
                           "state_fips": rsem.zpad("state_fips", 2)})
    return out.drop("totvotes", "trump_votes")
