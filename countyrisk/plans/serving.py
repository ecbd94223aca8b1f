"""Analyst queries over the current marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fips
from ..operators import keys, ranking

MAP_RANKS, MAP_CAP = 1000, 1500


def available_years(mart: DataFrame) -> DataFrame:
    return mart.select("year").distinct().orderBy("year")


def health_counts(mart: DataFrame, centroids: DataFrame, summary: DataFrame, year: int) -> DataFrame:
    """Rows of the three tables for a year (one row)."""
    in_year = F.col("year") == year
    return mart.filter(in_year).agg(F.count("*").alias("risk_rows_year")).select(
        F.lit(str(year)).alias("selected_year"),
        "risk_rows_year",
        centroids.agg(F.count("*")).scalar().alias("centroid_rows"),
        summary.filter(in_year).agg(F.count("*")).scalar().alias("noaa_rows_year"),
    )


def year_kpis(mart: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Per year: share of rows without events and the median score with and without.

    The medians are mergeable sketches, so a year with most of the rows is no hot spot.
    """
    quiet = ranking.no_events()
    score = F.col("nri_risk_score")
    return mart.groupBy("year").agg(
        (100.0 * F.avg(F.when(quiet, 1.0).otherwise(0.0))).alias("pct_noaa_zero"),
        F.percentile_approx(F.when(quiet, score), 0.5, accuracy).alias("median_nri_noaa_zero"),
        F.percentile_approx(F.when(~quiet, score), 0.5, accuracy).alias("median_nri_noaa_pos"),
    )


def kpis_of_year(mart: DataFrame, year: int) -> DataFrame:
    return year_kpis(mart.filter(F.col("year") == year)).drop("year")


def directory(centroids: DataFrame) -> DataFrame:
    return centroids.select(
        F.lpad(F.col("county_fips").cast("string"), 5, "0").alias("county_fips"), "county_name", "state"
    ).orderBy("state", "county_name", "county_fips")


def search_directory(centroids: DataFrame, text: str = "", state: str | None = None) -> DataFrame:
    """Directory rows of a state whose name contains the text, in any case."""
    found = directory(centroids)
    if state is not None:
        found = found.filter(F.col("state") == state)
    if text:
        found = found.filter(F.coalesce(F.lower("county_name").contains(text.lower()), F.lit(False)))
    return found


def county_lookup(centroids: DataFrame, county: str) -> DataFrame:
    return (
        centroids.filter(F.col("county_fips") == fips.user_key(county))
        .select("county_fips", "county_name", "state", F.col("lat").cast("double"), F.col("lon").cast("double"))
        .limit(1)
    )


def county_series(mart: DataFrame, county: str | None = None, years: int = 5) -> DataFrame:
    """Series with trailing means and registrations per event; all counties without a key."""
    if county is not None:
        mart = mart.filter(F.col("county_fips") == fips.user_key(county))
    return ranking.trailing_means(mart, years).withColumn("claims_per_event", ranking.per_event())


def ranked_with_centroids(ranked: DataFrame, centroids: DataFrame) -> DataFrame:
    return keys.add_centroids(ranked, centroids)


def quiet_share(ranked: DataFrame) -> DataFrame:
    """Percentage of rows without events in a ranked set (one row)."""
    return ranked.agg((100.0 * F.avg(F.when(ranking.no_events(), 1.0).otherwise(0.0))).alias("zero_event_pct"))


def map_payload(
    mart: DataFrame,
    centroids: DataFrame,
    mode: str,
    year: int,
    colour_by: str = "nri_risk_score",
    size_by: str | None = "fema_total_damage",
    only_quiet: bool = False,
    ranks: int = MAP_RANKS,
    head: int = MAP_RANKS,
    cap: int = MAP_CAP,
) -> DataFrame:
    """Ranked counties with coordinates, radius and colour: the first ``ranks`` of the ranking,
    of those left by the filter the first ``head``, and of those on the map at most ``cap``."""
    order = [*[F.col(c).desc_nulls_last() for c in ranking.RANK_MODES[mode]], F.col("county_fips").asc()]
    ranked = keys.add_centroids(ranking.rank_counties(mart, mode, year, ranks), centroids)
    view = ranking.ranked_view(ranked, only_quiet, head, order)
    return ranking.map_points(view, colour_by, size_by, order, cap)


def county_snapshot(mart: DataFrame) -> DataFrame:
    """Latest year of each county with its headline figures."""
    return ranking.latest_snapshot(
        mart, ["nri_risk_score", "noaa_event_count", "fema_valid_registrations", "fema_total_damage"]
    )
