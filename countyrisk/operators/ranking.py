"""Ranked lists, trailing averages and map attributes over the feature mart.

Every ranking ends with the county key, so ties come out the same on each run.
``orderBy`` with ``limit`` is planned as one top-k per task and a merge of those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import display, fips

RANK_COLUMNS = (
    "county_fips",
    "year",
    "nri_risk_score",
    "noaa_event_count",
    "fema_valid_registrations",
    "fema_total_damage",
)

# Sort columns of each ranking mode, greatest first.
RANK_MODES = {
    "structural": ("nri_risk_score",),
    "frequency": ("noaa_event_count", "fema_valid_registrations"),
    "impact": ("fema_total_damage", "fema_valid_registrations"),
    "outcomes": ("fema_valid_registrations", "fema_total_damage"),
}


def top(df: DataFrame, by: Sequence[str], limit: int | None, tie_break: Sequence[str] = ("county_fips",)) -> DataFrame:
    ordered = df.orderBy(*[F.col(c).desc_nulls_last() for c in by], *[F.col(c).asc_nulls_last() for c in tie_break])
    return ordered if limit is None else ordered.limit(limit)


def rank_counties(mart: DataFrame, mode: str, year: int, limit: int | None = None) -> DataFrame:
    if mode not in RANK_MODES:
        raise ValueError(f"unknown ranking mode {mode!r}")
    return top(mart.filter(F.col("year") == year).select(*RANK_COLUMNS), RANK_MODES[mode], limit)


def no_events() -> Column:
    return F.coalesce(F.col("noaa_event_count"), F.lit(0)) == 0


def per_event(amount: str = "fema_valid_registrations", events: str = "noaa_event_count") -> Column:
    """Amount per event, NULL where there was no event."""
    return F.col(amount).cast("double") / F.nullif(F.col(events).cast("double"), F.lit(0.0))


def claim_intensity(
    mart: DataFrame, first: int, last: int, limit: int | None = None, digits: int = 2
) -> DataFrame:
    """Registrations per event, greatest first, over a range of years."""
    shaped = mart.filter(F.col("year").between(first, last)).select(
        "county_fips",
        "year",
        "fema_valid_registrations",
        "noaa_event_count",
        F.round(per_event(), digits).alias("claims_per_event"),
    )
    return top(shaped, ["claims_per_event"], limit, ["county_fips", "year"])


def quiet_but_risky(mart: DataFrame, year: int, limit: int | None = None) -> DataFrame:
    """Counties without events in the year, by structural risk."""
    kept = mart.filter((F.col("year") == year) & no_events()).select(*RANK_COLUMNS)
    return top(kept, ["nri_risk_score", "fema_valid_registrations"], limit)


def hazard_breakdown(summary: DataFrame, county: str, year: int, limit: int | None = None) -> DataFrame:
    """Hazards of one county and year by event count. Marts hold standard keys, so the key as
    typed is brought to that form and the scan is filtered by it."""
    kept = summary.filter((F.col("county_fips") == fips.user_key(county)) & (F.col("year") == year)).select(
        "hazard_type", "hazard_category", "event_count", "total_fatalities", "total_injuries", "avg_property_damage"
    )
    return top(kept, ["event_count"], limit, ["hazard_type", "hazard_category"])


def top_by_mean(mart: DataFrame, metric: str = "nri_risk_score", out: str = "avg_risk", limit: int | None = None) -> DataFrame:
    return top(mart.groupBy("county_fips").agg(F.avg(metric).alias(out)), [out], limit)


def ranked_view(ranked: DataFrame, only_quiet: bool, head: int, order: Sequence[Column]) -> DataFrame:
    """Filter a ranked set after its limit, then take the head of what is left."""
    kept = ranked.filter(no_events()) if only_quiet else ranked
    return kept.orderBy(*order).limit(head)


ROLLING = {
    "noaa_event_count": "noaa_events_roll",
    "fema_valid_registrations": "fema_regs_roll",
    "fema_total_damage": "fema_damage_roll",
}


def trailing_means(mart: DataFrame, years: int = 5) -> DataFrame:
    """Mean over the last ``years`` rows of each county.

    The mart has one row per county and year, so a window group is as long as the
    year range and no longer.
    """
    window = Window.partitionBy("county_fips").orderBy("year").rowsBetween(-(years - 1), 0)
    return mart.select(
        "county_fips",
        "year",
        *[F.col(c).cast("double").alias(c) for c in ROLLING],
        "nri_risk_score",
        *[F.avg(F.col(c).cast("double")).over(window).alias(f"{out}{years}") for c, out in ROLLING.items()],
    )


def latest_snapshot(mart: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest year of each county with the given columns, by one ``max_by``."""
    row = F.struct("year", *columns)
    return (
        mart.filter("year IS NOT NULL")
        .groupBy("county_fips")
        .agg(F.max_by(row, "year").alias("__row"))
        .select("county_fips", "__row.*")
    )


# Ranks that a quantile sketch may be off by are rows / SKETCH; the median is looked for this far around.
SKETCH = 10_000
MARGIN = 5 / SKETCH


def exact_median(df: DataFrame, value: Column) -> DataFrame:
    """``median`` of the non-null values (one row), the mean of the two middle ones if their number is even.

    A mergeable sketch gives two values that are sure to have the middle between them. The values between,
    a thousandth of all, are counted by value and ranked by running totals, those below are only
    counted; so no task has more than that thousandth. No values give a NULL."""
    values = df.select(value.cast("double").alias("v")).filter("v IS NOT NULL")
    around = F.percentile_approx("v", [0.5 - MARGIN, 0.5 + MARGIN], SKETCH)
    bounds = values.agg(around.alias("around"), F.count("*").alias("n"))
    low, high, n = (bounds.select(c).scalar() for c in (F.col("around")[0], F.col("around")[1], F.col("n")))
    below = values.filter(F.col("v") < low).agg(F.count("*")).scalar()
    near = values.filter((F.col("v") >= low) & (F.col("v") <= high)).groupBy("v").agg(F.count("*").alias("times"))
    upto = below + F.sum("times").over(Window.orderBy("v"))
    ranked = near.select("v", upto.alias("upto"))
    middle = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    return ranked.agg(((middle(F.floor((n - 1) / 2)) + middle(F.floor(n / 2))) / 2).alias("median"))


def metric_range(df: DataFrame, metric: str) -> DataFrame:
    """Least, median and greatest value for a legend (one row)."""
    value = F.col(metric).cast("double")
    return df.agg(F.min(value).alias("low"), F.max(value).alias("high")).select(
        "low", exact_median(df, value).scalar().alias("median"), "high"
    )


def largest(df: DataFrame, metric: str) -> Column:
    """Greatest non-negative value of a column as a scalar subquery."""
    return df.agg(F.max(F.greatest(F.col(metric).cast("double"), F.lit(0.0)))).scalar()


def map_points(
    ranked: DataFrame, colour_by: str, size_by: str | None, order: Sequence[Column], cap: int
) -> DataFrame:
    """Rows with coordinates, capped, with radius and colour."""
    points = ranked.filter("lat IS NOT NULL AND lon IS NOT NULL").orderBy(*order).limit(cap)
    # the capped set is one task's rows already, so its maxima are a window over it
    everything = Window.partitionBy()
    most = lambda metric: F.max(F.greatest(F.col(metric).cast("double"), F.lit(0.0))).over(everything)
    points = points.withColumn("__colour_top", most(colour_by))
    if size_by is not None:
        points = points.withColumn("__size_top", most(size_by))
    radius = F.lit(display.FLAT_RADIUS) if size_by is None else display.point_radius(size_by, F.col("__size_top"))
    return (
        points.withColumns({"radius": radius, "colour_index": display.point_colour_index(colour_by, F.col("__colour_top"))})
        .withColumn("colour", display.point_colour("colour_index"))
        .drop("__colour_top", "__size_top")
    )
