"""Event roll-ups and year sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import YearWindow
from ..functions import casts, damage, fips


def in_window(df: DataFrame, window: YearWindow, column: str = "year") -> DataFrame:
    return df.filter(F.col(column).between(window.first, window.last))


def _event_measures(parser: str) -> dict:
    return {
        "fatalities": casts.zero_sum("deaths_direct", "deaths_indirect"),
        "injuries": casts.zero_sum("injuries_direct", "injuries_indirect"),
        "damage_usd": damage.damage_usd("damage_property", parser),
    }


def events_by_hazard(events: DataFrame, window: YearWindow | None, parser: str = "strict") -> DataFrame:
    """Count, fatalities, injuries and mean damage per county, hazard, category, year."""
    kept = events.filter(fips.sane_condition("county_fips")).withColumn("year", F.col("year").cast("int"))
    if window is not None:
        kept = in_window(kept, window)
    shaped = kept.filter("year IS NOT NULL").select(
        "county_fips",
        F.col("event_type").alias("hazard_type"),
        casts.default_text("category").alias("hazard_category"),
        "year",
        *[c.alias(n) for n, c in _event_measures(parser).items()],
    )
    return summarize_hazards(shaped)


def summarize_hazards(shaped: DataFrame) -> DataFrame:
    return (
        shaped.groupBy("county_fips", "hazard_type", "hazard_category", "year")
        .agg(
            F.count("*").alias("event_count"),
            F.sum("fatalities").alias("total_fatalities"),
            F.sum("injuries").alias("total_injuries"),
            F.avg("damage_usd").alias("avg_property_damage"),
        )
        .select(
            "county_fips",
            "hazard_type",
            "hazard_category",
            "event_count",
            "total_fatalities",
            "total_injuries",
            "avg_property_damage",
            "year",
        )
    )


def events_by_hazard_lenient(events: DataFrame) -> DataFrame:
    """Variant: year of the begin time, all keys, lenient damage, no year window."""
    shaped = events.filter(
        "county_fips IS NOT NULL AND begin_date_time IS NOT NULL AND event_type IS NOT NULL"
    ).select(
        fips.standard_fips("county_fips").alias("county_fips"),
        F.col("event_type").alias("hazard_type"),
        casts.default_text("category").alias("hazard_category"),
        F.year("begin_date_time").alias("year"),
        *[c.alias(n) for n, c in _event_measures("lenient").items()],
    )
    return summarize_hazards(shaped)


def events_by_county_year(events: DataFrame, window: YearWindow | None = None) -> DataFrame:
    """Event features per county and year, straight from the events."""
    kept = events.filter(fips.sane_condition("county_fips")).withColumn("year", F.col("year").cast("int"))
    if window is not None:
        kept = in_window(kept, window)
    return (
        kept.filter("year IS NOT NULL")
        .select(F.trim("county_fips").alias("county_fips"), "year", *[c.alias(n) for n, c in _event_measures("strict").items()])
        .groupBy("county_fips", "year")
        .agg(
            F.count("*").alias("noaa_event_count"),
            F.sum("fatalities").alias("noaa_total_fatalities"),
            F.sum("injuries").alias("noaa_total_injuries"),
            F.avg("damage_usd").alias("noaa_avg_property_damage"),
        )
    )


def summary_by_county_year(summary: DataFrame) -> DataFrame:
    """Variant: features from the summary, damage as the mean of its means."""
    return summary.groupBy("county_fips", "year").agg(
        F.sum("event_count").alias("noaa_event_count"),
        F.sum("total_fatalities").alias("noaa_total_fatalities"),
        F.sum("total_injuries").alias("noaa_total_injuries"),
        F.avg("avg_property_damage").alias("noaa_avg_property_damage"),
    )


def summary_by_group(summary: DataFrame, type_map: DataFrame) -> DataFrame:
    """County, year and hazard group; unmapped hazards keep a NULL group.

    The summary is first rolled up to the hazard type, then decoded, so the join
    moves one row per county, year and type. The map is not broadcast by force:
    Spark does that itself where its size allows.
    """
    by_type = summary.groupBy("county_fips", "year", "hazard_type").agg(
        F.sum("event_count").alias("event_count"),
        F.sum("total_fatalities").alias("total_fatalities"),
        F.sum("total_injuries").alias("total_injuries"),
        F.sum("avg_property_damage").alias("__damage"),
        F.count("avg_property_damage").alias("__damage_rows"),
    )
    decode = type_map.select(F.col("event_type").alias("hazard_type"), "hazard_group")
    return (
        by_type.join(decode, "hazard_type", "left")
        .groupBy("county_fips", "year", "hazard_group")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("total_fatalities").alias("total_fatalities"),
            F.sum("total_injuries").alias("total_injuries"),
            (F.sum("__damage") / F.nullif(F.sum("__damage_rows"), F.lit(0))).alias("avg_property_damage"),
        )
    )


def declarations_by_county_year(declarations: DataFrame) -> DataFrame:
    return (
        declarations.filter("county_fips IS NOT NULL AND fydeclared IS NOT NULL")
        .select(fips.standard_fips("county_fips").alias("county_fips"), F.col("fydeclared").try_cast("int").alias("year"))
        .filter("year IS NOT NULL")
        .groupBy("county_fips", "year")
        .agg(F.count("*").alias("fema_declaration_count"))
    )


def years_in_scope(events: DataFrame, declarations: DataFrame, window: YearWindow | None = None) -> DataFrame:
    """Distinct years of the begin times and of the fiscal years."""
    years = (
        events.select(F.year("begin_date_time").alias("year"))
        .distinct()
        .union(declarations.select(F.col("fydeclared").try_cast("int").alias("year")).distinct())
        .filter("year IS NOT NULL")
        .distinct()
    )
    return in_window(years, window) if window is not None else years


def county_year_universe(counties: DataFrame, years: DataFrame) -> DataFrame:
    """Every county with every year.

    The years are gathered into one array (a set of ints, one per distinct year) that
    is exploded per county: the same rows as a cross join, without one in the plan.
    """
    year_set = years.agg(F.sort_array(F.collect_set("year")).alias("years")).scalar()
    return counties.select("county_fips", year_set.alias("__years")).select(
        "county_fips", F.explode("__years").alias("year")
    )
