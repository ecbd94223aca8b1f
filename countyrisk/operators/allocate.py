"""Spread claims over counties: by ZIP weight, or in equal shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import YearWindow
from ..functions import casts, fips
from ..schemas import CLAIM_MEASURES


def _not_blank(column: str):
    return F.col(column).isNotNull() & (F.trim(column) != "")


def disaster_years(declarations: DataFrame, window: YearWindow = YearWindow()) -> DataFrame:
    """Distinct (disaster, state, fiscal year) inside the window."""
    year = F.col("fydeclared")
    return (
        declarations.filter(
            F.col("disasternumber").isNotNull() & _not_blank("state") & year.between(window.first, window.last)
        )
        .select("disasternumber", F.trim("state").alias("state"), year.try_cast("int").alias("year"))
        .distinct()
    )


def crosswalk_window(crosswalk: DataFrame, window: YearWindow = YearWindow()) -> DataFrame:
    year = F.col("year").cast("int")
    return crosswalk.filter(year.between(window.first, window.last) & fips.sane_condition("county_fips")).select(
        F.trim("zip5").alias("zip5"),
        F.trim("county_fips").alias("county_fips"),
        year.alias("year"),
        F.col("tot_ratio").cast("double").alias("tot_ratio"),
    )


def claims_by_zip(claims: DataFrame, amount_type: str = "double") -> DataFrame:
    """Claim measures summed per (disaster, state, ZIP) ahead of the joins.

    The sums are built map-side, so a ZIP or a disaster with a large share of all
    claims leaves each task as one row, and the joins that follow see no hot key.
    """
    return (
        claims.filter(F.col("disasternumber").isNotNull() & _not_blank("state") & F.col("zipcode").isNotNull())
        .withColumn("zip5", fips.zip_from_text("zipcode"))
        .filter(F.col("zip5").isNotNull())
        .groupBy("disasternumber", F.trim("state").alias("state"), "zip5")
        .agg(*[F.sum(casts.zero_if_null(F.col(m).cast(amount_type))).alias(m) for m in CLAIM_MEASURES])
    )


def allocate_by_zip(
    claims: DataFrame,
    declarations: DataFrame,
    crosswalk: DataFrame,
    window: YearWindow = YearWindow(),
    amount_type: str = "double",
) -> DataFrame:
    """County-year claim features: each measure times the ZIP's share in the county.

    A missing share counts as 1. A disaster with two fiscal years adds its claims to
    both, as in the reference results (see :func:`disaster_fan_out`). Doubles follow
    the contract; give a decimal ``amount_type`` for sums that do not depend on order.

    Claims are summed per ZIP and year, and weights per ZIP, year and county, before the two
    meet, so the join has no more rows than the crosswalk however many claims a ZIP has.
    """
    years, shares = disaster_years(declarations, window), crosswalk_window(crosswalk, window)
    weight = F.coalesce("tot_ratio", F.lit(1.0)).cast(amount_type)
    weights = shares.groupBy("zip5", "year", "county_fips").agg(F.sum(weight).alias("__weight"))
    totals = (
        claims_by_zip(claims, amount_type)
        .join(years, ["disasternumber", "state"])
        .groupBy("zip5", "year")
        .agg(*[F.sum(m).alias(m) for m in CLAIM_MEASURES])
    )
    amounts = (
        totals.join(weights, ["zip5", "year"])
        .groupBy("county_fips", "year")
        .agg(*[F.sum(F.col(m) * F.col("__weight")).cast("double").alias(out) for m, out in CLAIM_MEASURES.items()])
    )
    return amounts.join(disasters_by_county(claims_by_zip(claims), years, shares), ["county_fips", "year"])


def disasters_by_county(claims: DataFrame, years: DataFrame, shares: DataFrame) -> DataFrame:
    """Distinct disasters per county and year, through the ZIPs of their claims.

    A ZIP's counties travel as one list of numbers, and are told apart where the rows of a
    disaster already lie: pairs of a claim and a county are never shuffled.
    """
    numbered = shares.select("county_fips").distinct().select("county_fips", F.row_number().over(Window.orderBy("county_fips")).alias("__county"))
    counties = (
        shares.select("zip5", "year", "county_fips")
        .join(numbered, "county_fips")
        .groupBy("zip5", "year")
        .agg(F.collect_set("__county").alias("__counties"))
    )
    seen = claims.select("disasternumber", "state", "zip5").join(years, ["disasternumber", "state"])
    return (
        seen.join(counties, ["zip5", "year"])
        .repartition("disasternumber", "year")
        .select("disasternumber", "year", F.explode("__counties").alias("__county"))
        .distinct()
        .groupBy("__county", "year")
        .agg(F.count("*").alias("fema_declaration_count"))
        .join(numbered, "__county")
        .select("county_fips", "year", "fema_declaration_count")
    )


def claims_by_county_of_zip(
    claims: DataFrame, declarations: DataFrame, crosswalk: DataFrame, window: YearWindow = YearWindow()
) -> DataFrame:
    """Claims of each disaster, fiscal year and ZIP in each county the ZIP has a row for, as often as it has one.

    Claims are counted per disaster, year and ZIP, and crosswalk rows per ZIP, year and county, before the two meet. So each
    pair they make is a row of the result, and the pairs, which are many times the claims, are neither shuffled nor grouped.
    """
    per_zip = (
        claims.withColumn("zip5", fips.zip_from_text("zipcode"))
        .groupBy("disasternumber", F.trim("state").alias("state"), "zip5")
        .agg(F.count("*").alias("claims"))
    )
    # dealt as the join needs them, which keeps the rows of a group together as well
    dated = (
        per_zip.join(disaster_years(declarations, window), ["disasternumber", "state"])
        .repartition("zip5", "year")
        .groupBy("disasternumber", "year", "zip5")
        .agg(F.sum("claims").alias("claims"))
    )
    times = crosswalk_window(crosswalk, window).groupBy("zip5", "year", "county_fips").agg(F.count("*").alias("__times"))
    return dated.join(times, ["zip5", "year"]).select(
        "disasternumber", "year", "zip5", "county_fips", (F.col("claims") * F.col("__times")).alias("claims")
    )


def disaster_fan_out(declarations: DataFrame, window: YearWindow = YearWindow()) -> DataFrame:
    """Disasters whose claims are counted in more than one fiscal year."""
    return (
        disaster_years(declarations, window)
        .groupBy("disasternumber", "state")
        .agg(F.count("*").alias("fiscal_years"))
        .filter("fiscal_years > 1")
    )


def disaster_county_map(declarations: DataFrame) -> DataFrame:
    """Distinct (disaster, county, fiscal year)."""
    return (
        declarations.filter("disasternumber IS NOT NULL AND county_fips IS NOT NULL AND fydeclared IS NOT NULL")
        .select(
            F.col("disasternumber").cast("bigint").alias("disasternumber"),
            fips.standard_fips("county_fips").alias("county_fips"),
            F.col("fydeclared").try_cast("int").alias("year"),
        )
        .filter("year IS NOT NULL")
        .distinct()
    )


def disaster_county_counts(county_map: DataFrame) -> DataFrame:
    return county_map.groupBy("disasternumber", "year").agg(F.count_distinct("county_fips").alias("county_cnt"))


def claims_by_disaster(claims: DataFrame) -> DataFrame:
    return (
        claims.filter("disasternumber IS NOT NULL")
        .groupBy(F.col("disasternumber").cast("bigint").alias("disasternumber"))
        .agg(*[F.sum(casts.zero_if_null(F.col(m).cast("double"))).alias(m) for m in CLAIM_MEASURES])
    )


def allocate_equally(claims: DataFrame, declarations: DataFrame) -> DataFrame:
    """County-year claim features: each disaster's sums over its number of counties.

    The shares are worked out per (disaster, year), before the map spreads them over
    the counties, so the large side of the last join carries finished numbers.
    """
    county_map = disaster_county_map(declarations)
    shares = (
        disaster_county_counts(county_map)
        .join(claims_by_disaster(claims), "disasternumber")
        .select(
            "disasternumber",
            "year",
            *[(F.col(m) / F.nullif(F.col("county_cnt"), F.lit(0))).alias(m) for m in CLAIM_MEASURES],
        )
    )
    return (
        county_map.join(shares, ["disasternumber", "year"])
        .groupBy("county_fips", "year")
        .agg(*[F.sum(m).alias(out) for m, out in CLAIM_MEASURES.items()])
    )
