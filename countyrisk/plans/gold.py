"""Marts and helper views over the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import YearWindow
from ..functions import casts, fips, geonames
from ..operators import allocate, dedupe, keys, rollups


def hazard_event_summary(events: DataFrame, window: YearWindow = YearWindow()) -> DataFrame:
    """Events per county, hazard, category and year."""
    return rollups.events_by_hazard(events, window)


def hazard_event_summary_lenient(events: DataFrame) -> DataFrame:
    return rollups.events_by_hazard_lenient(events)


def county_scores(scores: DataFrame) -> DataFrame:
    """Scores as doubles under their mart names, sane keys only."""
    return keys.keep_sane(scores).select(
        fips.standard_fips("county_fips").alias("county_fips"),
        *[F.col(c).try_cast("double").alias(out) for c, out in schemas.NRI_SCORES.items()],
    )


def census_latest(census: DataFrame, sane_only: bool = True) -> DataFrame:
    """Latest census row of each county."""
    kept = census.filter("county_fips IS NOT NULL AND acs_year IS NOT NULL")
    kept = keys.keep_sane(kept) if sane_only else kept
    shaped = kept.select(
        fips.standard_fips("county_fips").alias("county_fips"),
        F.col("acs_year").cast("int").alias("acs_year"),
        *[F.col(c).cast("bigint").alias(c) for c in schemas.CENSUS_MEASURES],
    )
    return dedupe.latest_per_key(shaped, "county_fips", "acs_year")


def feature_mart(
    events: DataFrame,
    claims: DataFrame,
    declarations: DataFrame,
    crosswalk: DataFrame,
    census: DataFrame,
    scores: DataFrame,
    window: YearWindow = YearWindow(),
    amount_type: str = "double",
) -> DataFrame:
    """One row per county and year that has an event or an allocated claim.

    Both feature frames are unique by county and year and already partitioned by
    them, so their full outer join is the universe and both left joins at once, with
    no further shuffle. Event and claim features default to zero, census and scores
    stay NULL.
    """
    grain = ["county_fips", "year"]
    by_event = rollups.events_by_county_year(events, window)
    by_claim = allocate.allocate_by_zip(claims, declarations, crosswalk, window, amount_type)
    features = casts.default_zeros(
        by_event.join(by_claim, grain, "full_outer"), (*schemas.EVENT_FEATURES, *schemas.CLAIM_FEATURES)
    )
    return (
        features.join(census_latest(census).withColumnRenamed("acs_year", "census_acs_year"), "county_fips", "left")
        .join(county_scores(scores), "county_fips", "left")
        .select(*schemas.FEATURE_MART_COLUMNS)
    )


def feature_mart_scaffold(
    universe: DataFrame,
    summary: DataFrame,
    claims: DataFrame,
    declarations: DataFrame,
    census: DataFrame,
    scores: DataFrame,
) -> DataFrame:
    """Variant: every county-year of the universe, claims in equal shares."""
    grain = ["county_fips", "year"]
    joined = (
        universe.join(rollups.summary_by_county_year(summary), grain, "left")
        .join(allocate.allocate_equally(claims, declarations), grain, "left")
        .join(rollups.declarations_by_county_year(declarations), grain, "left")
    )
    features = casts.default_zeros(joined, (*schemas.EVENT_FEATURES, *schemas.CLAIM_FEATURES))
    latest = census_latest(census, sane_only=False).withColumnRenamed("acs_year", "census_acs_year")
    return (
        features.join(latest, "county_fips", "left")
        .join(county_scores(scores), "county_fips", "left")
        .select(*schemas.FEATURE_MART_COLUMNS)
    )


def census_latest_name(census: DataFrame) -> DataFrame:
    named = census.filter("county_fips IS NOT NULL AND county_name IS NOT NULL AND acs_year IS NOT NULL").select(
        fips.standard_fips("county_fips").alias("county_fips"), "county_name", "acs_year"
    )
    return dedupe.latest_per_key(named, "county_fips", "acs_year").select("county_fips", "county_name")


def county_dim(scores: DataFrame, census: DataFrame) -> DataFrame:
    """Readable county and state names of every sane key of the risk index."""
    base = (
        keys.keep_sane(scores)
        .groupBy(fips.standard_fips("county_fips").alias("county_fips"))
        .agg(
            F.max("state").alias("state"),
            F.max("statefips").alias("__state_fips"),
            geonames.without_listed_state(geonames.without_last_part(F.max("county"))).alias("__nri_name"),
        )
    )
    census_names = census_latest_name(census).withColumnRenamed("county_name", "__census_raw")
    named = base.join(census_names, "county_fips", "left").withColumn(
        "__name",
        geonames.display_name(
            "county_fips", "__nri_name", geonames.without_state_suffix("__census_raw", "state")
        ),
    )
    shown = geonames.without_trailing_state("__name", "state")
    return named.select(
        "county_fips",
        shown.alias("county_name"),
        "state",
        fips.state_digits("__state_fips").alias("state_fips"),
        geonames.search_form(shown).alias("county_name_normalized"),
    )


def county_year_universe(dim: DataFrame, years: DataFrame) -> DataFrame:
    return rollups.county_year_universe(dim, years)


def county_centroids(gazetteer: DataFrame) -> DataFrame:
    """Key, name, state and coordinates from a gazetteer table (own definition)."""
    shaped = gazetteer.select(
        fips.standard_fips("county_fips").alias("county_fips"),
        F.col("county_name"),
        F.col("state"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
    )
    return dedupe.dedupe(keys.keep_sane(shaped), ["county_fips"])


def county_risk_scores(spark: SparkSession) -> DataFrame:
    """Empty table for model scores."""
    return spark.createDataFrame([], schemas.COUNTY_RISK_SCORES)
