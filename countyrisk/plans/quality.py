"""Check suites of the raw, cleaned and mart tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..config import KNOWN_BAD_FIPS, YearWindow
from ..operators import checks
from ..operators.checks import Check, Suite

SUMMARY_METRICS = ("event_count", "total_fatalities", "total_injuries", "avg_property_damage")
MART_METRICS = (*schemas.EVENT_FEATURES, *schemas.CLAIM_FEATURES[:4])
CLAIM_METRICS = tuple(schemas.CLAIM_MEASURES.values())
GRAIN_KEYS = ("event_id", "episode_id", "state", "state_fips", "cz_fips", "event_type", "year")
COVERED = ("nri_risk_score", "nri_resl_score", "population_total", "median_household_income")


def bronze_events_suite(raw: DataFrame) -> Suite:
    return Suite(
        "bronze_events",
        raw,
        [
            Check("rowcount_nonzero", lambda: rowcount_nonzero(raw)),
            Check("schema_required", lambda: checks.required_columns(raw, schemas.EVENT_REQUIRED)),
        ],
    )


def rowcount_nonzero(df: DataFrame) -> DataFrame:
    """0 or 1; reads no more than one row."""
    return df.limit(1).agg(checks.not_empty().alias("failures"))


def exclude_files(df: DataFrame, pattern: str | None) -> DataFrame:
    """Rows of all files but those whose path has a match of ``pattern``; the scan itself compares."""
    return df.filter(~F.col("_metadata.file_path").rlike(pattern)) if pattern else df


def silver_events_suite(events: DataFrame, exclude: str | None = None) -> Suite:
    kept = exclude_files(events, exclude)
    return Suite(
        "silver_events",
        kept,
        [
            Check("grain_keys_not_null", checks.any_null(GRAIN_KEYS)),
            Check("year_partition_complete", checks.year_complete()),
        ],
    )


def summary_suite(
    summary: DataFrame, reference: DataFrame, grain: Sequence[str] = ("county_fips", "year", "hazard_type", "hazard_category")
) -> Suite:
    """Gate of the summary. The category is part of its grain."""
    return Suite(
        "hazard_event_summary",
        summary,
        [
            Check("nonnegative_metrics", checks.any_negative(SUMMARY_METRICS)),
            Check("county_fips_canonical", checks.Referential(reference)),
            Check("grain_unique", checks.Unique(grain)),
        ],
    )


def mart_suite(
    mart: DataFrame, reference: DataFrame, universe: DataFrame, window: YearWindow = YearWindow()
) -> Suite:
    """Gate of the feature mart against the universe it was built from."""
    grain = ("county_fips", "year")
    return Suite(
        "risk_feature_mart",
        mart,
        [
            Check("year_window", checks.outside_window(window.first, window.last)),
            Check("county_fips_canonical", checks.Referential(reference)),
            Check("county_year_coverage", checks.Covers(universe, grain)),
            Check("grain_unique", checks.Unique(grain)),
        ],
    )


def universe_mismatch(dim: DataFrame, years: DataFrame, universe: DataFrame) -> DataFrame:
    """Counties, years, their product and the universe rows, only where they differ."""
    counts = dim.agg(F.count("*").alias("counties")).select(
        "counties",
        years.agg(F.count("*")).scalar().alias("years"),
        universe.agg(F.count("*")).scalar().alias("universe_rows"),
    )
    product = F.col("counties") * F.col("years")
    return counts.filter(product != F.col("universe_rows")).select(
        "counties", "years", product.alias("expected_universe_rows"), "universe_rows"
    )


def coverage(df: DataFrame, columns: Iterable[str] = COVERED) -> DataFrame:
    """Rows and the NULL percentage of each column (one row, one pass)."""
    return df.agg(F.count("*").alias("rows"), *[checks.null_pct(c).alias(f"pct_null_{c}") for c in columns])


def coverage_failures(df: DataFrame, columns: Iterable[str] = COVERED, limit: float = 5.0) -> DataFrame:
    """The coverage row if the table is empty or a column is above the limit."""
    columns = list(columns)
    over = F.col("rows") == 0
    for c in columns:
        over = over | F.coalesce(F.col(f"pct_null_{c}") > limit, F.lit(False))
    return coverage(df, columns).filter(over)


def claims_match(claims: DataFrame, declarations: DataFrame) -> DataFrame:
    """Claim disasters that a declaration has, with counts (one row)."""
    return checks.match_rate(claims, declarations, "disasternumber").select(
        F.col("left_cnt").alias("claim_disaster_cnt"),
        F.col("right_cnt").alias("decl_disaster_cnt"),
        F.col("matched_cnt").alias("matched_disaster_cnt"),
        F.col("unmatched_cnt").alias("unmatched_claim_disaster_cnt"),
        "match_rate",
    )


def claims_match_failures(claims: DataFrame, declarations: DataFrame, least: float = 0.90) -> DataFrame:
    return claims_match(claims, declarations).filter(
        (F.col("claim_disaster_cnt") == 0) | (F.col("match_rate") < least)
    )


def known_bad_keys(mart: DataFrame, bad: Sequence[str] = KNOWN_BAD_FIPS) -> DataFrame:
    """Rows per known bad key; no row is the good case."""
    return mart.filter(F.col("county_fips").isin(*bad)).groupBy("county_fips").agg(F.count("*").alias("rows"))


def quarantine_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each quarantine table."""
    frames = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def any_rows_as_failures(violations: DataFrame) -> DataFrame:
    """A query that must return nothing, as a failure count."""
    return violations.agg(F.count("*").alias("failures"))


def legacy_suite(
    events: DataFrame,
    type_map: DataFrame,
    dim: DataFrame,
    years: DataFrame,
    universe: DataFrame,
    summary: DataFrame,
    mart: DataFrame,
    claims: DataFrame,
    declarations: DataFrame,
    county_scores: DataFrame,
) -> Suite:
    """The thirteen checks of the scaffold build, each a query that must return no row."""
    grain = ("county_fips", "year")
    must_be_empty = {
        "unmapped_hazards": lambda: checks.unmapped(events, type_map, "event_type", "event_type"),
        "county_dim_unique": lambda: checks.duplicate_groups(dim.select("county_fips"), ["county_fips"]),
        "universe_rowcount": lambda: universe_mismatch(dim, years, universe),
        "universe_unique": lambda: checks.duplicate_groups(universe.select(*grain), grain),
        "summary_unique": lambda: checks.duplicate_groups(summary, (*grain, "hazard_type", "hazard_category")),
        "summary_nonnegative": lambda: checks.violations(summary, SUMMARY_METRICS),
        "mart_rowcount": lambda: checks.row_counts_equal(universe, mart, ("universe_rows", "mart_rows")),
        "mart_unique": lambda: checks.duplicate_groups(mart.select(*grain), grain),
        "mart_nonnegative": lambda: checks.violations(mart, MART_METRICS),
        "mart_coverage": lambda: coverage_failures(mart),
        "claims_nonnegative": lambda: checks.violations(mart, CLAIM_METRICS),
        "claims_match": lambda: claims_match_failures(claims, declarations),
        "scores_parse": lambda: coverage_failures(county_scores, tuple(schemas.NRI_SCORES.values())),
    }
    as_count = lambda query: lambda: any_rows_as_failures(query())
    return Suite("risk_feature_mart_scaffold", mart, [Check(name, as_count(query)) for name, query in must_be_empty.items()])
