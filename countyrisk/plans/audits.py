"""Why a mart row has no structural risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING, NULL_SCORE, UNEXPECTED = (
    "missing_in_nri_reference",
    "present_in_nri_but_score_null",
    "unexpected_null_after_join",
)


def unscored(mart: DataFrame, scores: DataFrame) -> DataFrame:
    """Mart rows without a score, each with the reason."""
    reference = scores.filter("county_fips IS NOT NULL").select(
        F.trim("county_fips").alias("county_fips"),
        F.col("risk_score").try_cast("double").alias("__score"),
        F.lit(True).alias("__known"),
    )
    reason = (
        F.when(F.col("__known").isNull(), MISSING).when(F.col("__score").isNull(), NULL_SCORE).otherwise(UNEXPECTED)
    )
    return (
        mart.filter("nri_risk_score IS NULL")
        .join(reference, "county_fips", "left")
        .withColumn("nri_join_status", reason)
        .drop("__score", "__known")
    )


def feature_presence():
    events = F.coalesce(F.col("noaa_event_count"), F.lit(0)) > 0
    claims = F.coalesce(F.col("fema_valid_registrations"), F.lit(0)) > 0
    return (
        F.when(events & claims, "noaa_and_fema")
        .when(events, "noaa_only")
        .when(claims, "fema_only")
        .otherwise("neither_noaa_nor_fema")
    )


def null_summary(mart: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows per reason, feature presence and state."""
    return (
        unscored(mart, scores)
        .groupBy(
            "nri_join_status",
            feature_presence().alias("feature_presence"),
            F.substring("county_fips", 1, 2).alias("state_fips"),
        )
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), "nri_join_status", "feature_presence", "state_fips")
    )


def null_counties(mart: DataFrame, scores: DataFrame) -> DataFrame:
    """Counties by their number of rows without a score."""
    return (
        unscored(mart, scores)
        .groupBy("county_fips", F.substring("county_fips", 1, 2).alias("state_fips"), "nri_join_status")
        .agg(
            F.count("*").alias("null_year_rows"),
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
            F.sum(F.coalesce(F.col("noaa_event_count"), F.lit(0))).alias("total_noaa_events"),
            F.sum(F.coalesce(F.col("fema_valid_registrations"), F.lit(0))).alias("total_fema_registrations"),
        )
        .orderBy(F.desc("null_year_rows"), F.desc("total_noaa_events"), F.desc("total_fema_registrations"), "county_fips")
    )


def null_details(mart: DataFrame, scores: DataFrame, limit: int = 100) -> DataFrame:
    """The busiest rows without a score, for review."""
    zero = F.lit(0)
    return (
        unscored(mart, scores)
        .select(
            "county_fips",
            "year",
            F.coalesce("noaa_event_count", zero).alias("noaa_event_count"),
            F.coalesce("fema_valid_registrations", zero).alias("fema_valid_registrations"),
            F.coalesce("population_total", zero).alias("population_total"),
            "nri_join_status",
        )
        .orderBy(F.desc("noaa_event_count"), F.desc("fema_valid_registrations"), "county_fips", "year")
        .limit(limit)
    )
