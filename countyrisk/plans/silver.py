"""Cleaning jobs: raw frames in, typed tables out.

Each job is a function from raw frames to cleaned frames; reading and writing are
left to :mod:`countyrisk.plans.pipeline`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..functions import casts, fips, names
from ..operators import checks, dedupe, keys, resolve

EVENT_INTS = (
    "begin_yearmonth",
    "begin_day",
    "begin_time",
    "end_yearmonth",
    "end_day",
    "end_time",
    "injuries_direct",
    "injuries_indirect",
    "deaths_direct",
    "deaths_indirect",
)
EVENT_DOUBLES = ("magnitude", "tor_length", "tor_width", "begin_lat", "begin_lon", "end_lat", "end_lon")
EVENT_KEYS = ("event_id", "episode_id", "state", "state_fips", "cz_fips", "event_type", "year")

DECLARATION_INTS = (
    "disasternumber",
    "fydeclared",
    "ihprogramdeclared",
    "iaprogramdeclared",
    "paprogramdeclared",
    "hmprogramdeclared",
    "tribalrequest",
    "fipsstatecode",
    "fipscountycode",
    "placecode",
    "declarationrequestnumber",
    "incidentid",
    "region",
)
DECLARATION_DATES = (
    "declarationdate",
    "incidentbegindate",
    "incidentenddate",
    "disastercloseoutdate",
    "lastiafilingdate",
    "lastrefresh",
)
DECLARATION_FALLBACK_KEY = ("disasternumber", "county_fips", "incidenttype", "declarationtype")

# Census table -> source cell -> output column.
CENSUS_CELLS = {
    "b01001": {"b01001_001e": "population_total"},
    "b19013": {"b19013_001e": "median_household_income"},
    "b25077": {"b25077_001e": "median_home_value"},
    "b23025": {
        "b23025_001e": "employment_universe_total",
        "b23025_002e": "in_labor_force",
        "b23025_005e": "unemployed",
    },
    "b15003": {
        "b15003_001e": "education_universe_total",
        "b15003_017e": "high_school_grad",
        "b15003_022e": "bachelors",
        "b15003_025e": "graduate_degree",
    },
}


def keyed_events(raw: DataFrame) -> DataFrame:
    """Storm reports with a usable year and all grain keys present, other columns as read."""
    events = casts.with_year(names.make_unique_columns(names.normalize_columns(raw)))
    events = casts.blanks_to_null(events, ("state", "state_fips", "cz_fips", "event_type"))
    return casts.require_not_null(events, EVENT_KEYS)


def typed_events(events: DataFrame) -> DataFrame:
    """Times, counts and measures of keyed reports; damage stays text."""
    times = {
        c: casts.parse_timestamp(c, "year") for c in ("begin_date_time", "end_date_time") if c in events.columns
    }
    return casts.try_casts(
        events.withColumns(times),
        {"int": EVENT_INTS, "double": EVENT_DOUBLES, "string": ("damage_property", "damage_crops")},
    )


def unique_events(raw: DataFrame) -> DataFrame:
    """One typed row per event.

    Only the keys are worked out ahead of the shuffle; the other columns are parsed
    once, on the rows that stay.
    """
    return typed_events(unique_keyed(keyed_events(raw)))


def unique_keyed(events: DataFrame) -> DataFrame:
    """One row per event, other columns as read, of rows that have their keys already."""
    return dedupe.dedupe(events, ("event_id", "episode_id"))


def county_reference(nri_raw: DataFrame) -> DataFrame:
    """Counties with their matching names, from the raw risk-index file."""
    return resolve.canonical_counties(names.normalize_columns(nri_raw))


def clean_events(raw: DataFrame, counties: DataFrame) -> DataFrame:
    """Classified storm reports; :func:`resolve.split_outcomes` gives the outputs.

    Duplicates go first, while the rows are narrow; the three lookups are small enough to be broadcast,
    so the one shuffle of the events is the one by event id. ``counties`` is read once
    per lookup: give the written county reference rather than its plan.
    """
    return typed_events(matched_events(keyed_events(raw), counties))


def matched_events(keyed: DataFrame, counties: DataFrame) -> DataFrame:
    """Classified storm reports, other columns as read, of rows that have their keys already.

    Matching and typing (:func:`typed_events`) in one method are more than the JVM compiles (8000 bytes), so a
    write types the rows after it has sorted or dealt them by its partitions."""
    return matched_unique(unique_keyed(keyed), counties)


def matched_unique(unique: DataFrame, counties: DataFrame) -> DataFrame:
    """As :func:`matched_events`, of rows that have no duplicates."""
    return resolve.resolve_counties(resolve.with_candidate_key(unique), counties)


def clean_declarations(raw: DataFrame) -> DataFrame:
    typed = casts.try_casts(names.normalize_columns(raw), {"bigint": DECLARATION_INTS})
    typed = casts.try_dates(typed, DECLARATION_DATES)
    keyed = typed.withColumn(
        "county_fips", fips.standard_fips(fips.fips_from_codes("fipsstatecode", "fipscountycode"))
    )
    return dedupe.dedupe_with_fallback(keyed, ("id",), DECLARATION_FALLBACK_KEY)


def clean_claims(owners: DataFrame, renters: DataFrame) -> DataFrame:
    """Owners and renters as one fact table.

    The casts sit in the projection of each source, so Spark reads only those columns.
    """

    def shaped(raw: DataFrame, tenure: str) -> DataFrame:
        tagged = names.normalize_columns(raw).withColumn("tenure", F.lit(tenure))
        kept = [c for c in (*schemas.CLAIMS, "run_dt") if c in tagged.columns]
        typed = tagged.select(
            *[F.col(c).try_cast(schemas.CLAIMS[c]).alias(c) if c in schemas.CLAIMS else F.col(c) for c in kept]
        )
        return names.project_to(typed, {**schemas.CLAIMS, "run_dt": "string"})

    claims = shaped(owners, "owner").unionByName(shaped(renters, "renter"))
    return dedupe.dedupe(claims, ("id", "tenure")).drop("run_dt")


def keyed_scores(raw: DataFrame) -> DataFrame:
    """Risk-index rows with a standard key, one row per key."""
    scores = names.normalize_columns(raw)
    if "stcofips" in scores.columns:
        code = casts.blank_to_null("stcofips")
    elif "statefips" in scores.columns and "countyfips" in scores.columns:
        code = fips.fips_from_codes("statefips", "countyfips")
    else:
        raise ValueError("the file has neither stcofips nor statefips and countyfips")
    return dedupe.dedupe(scores.withColumn("county_fips", fips.standard_fips(code)), ["county_fips"])


def clean_scores(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a sane key, and the quarantined rest."""
    return keys.split_by_sanity(keyed_scores(raw))


def census_table(raw: DataFrame, table: str) -> DataFrame:
    """One census table: key and wanted cells, one row per county."""
    rows = names.normalize_columns(raw)
    cells = CENSUS_CELLS[table]
    code = fips.standard_fips(fips.fips_from_codes("state", "county"))
    columns = [code.alias("county_fips")]
    if table == "b01001":
        rows = names.canonical_name_column(rows)
        columns.append(F.col("name").alias("county_name"))
    columns += [F.col(cell).try_cast("bigint").alias(out) for cell, out in cells.items()]
    return dedupe.dedupe(rows.select(*columns), ["county_fips"])


def clean_census(tables: Mapping[str, DataFrame], acs_year: int = 2022) -> DataFrame:
    """One row per county of the population table, with the cells of the other four.

    Each table is already partitioned by county after its de-duplication, so the
    star of left joins adds no shuffle.
    """
    out = census_table(tables["b01001"], "b01001")
    for table in ("b19013", "b25077", "b23025", "b15003"):
        out = out.join(census_table(tables[table], table), "county_fips", "left")
    return out.withColumn("acs_year", F.lit(acs_year))


def clean_crosswalk(raw: DataFrame) -> DataFrame:
    """Main county of each ZIP and year with its weight."""
    main = F.lower(F.trim(F.col("top_match").cast("string"))).isin("true", "t", "1")
    shaped = names.normalize_columns(raw).filter(main).select(
        fips.padded_zip("zip").alias("zip5"),
        F.lpad(F.col("county").cast("string"), 5, "0").alias("county_fips"),
        F.col("year").try_cast("int").alias("year"),
        F.col("tot_ratio").try_cast("double").alias("tot_ratio"),
    )
    return keys.keep_sane(shaped).select("zip5", "county_fips", "tot_ratio", "year")


def job_metrics(
    dataset: str, raw: DataFrame, clean: Callable[[DataFrame], DataFrame], columns: Sequence[str], write: Callable[[DataFrame], None]
) -> DataFrame:
    """Run a job and give its rows in, rows out and NULL rates (one row), counted while it writes.

    ``write`` is the only action; neither the raw nor the cleaned rows are read again for the counts."""
    read, made = Observation(f"{dataset} read"), Observation(f"{dataset} written")
    cleaned = clean(raw.observe(read, F.count(F.lit(1)).alias("rows")))
    present = [c for c in columns if c in cleaned.columns]
    write(cleaned.observe(made, *null_rate_metrics(present)))
    rows = made.get["rows"]
    rates = [float(made.get[f"{c}_missing"] or 0) / rows if rows else None for c in present]
    schema = "dataset string, bronze_rows long, silver_rows long" + "".join(f", {c}_null_rate double" for c in present)
    return raw.sparkSession.createDataFrame([(dataset, read.get["rows"], rows, *rates)], schema)


def null_rate_metrics(columns: Sequence[str]):
    """Aggregates for ``DataFrame.observe``: rows and NULL rates of a write, for free."""
    return [
        F.count(F.lit(1)).alias("rows"),
        *[
            F.sum(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1).otherwise(0)).alias(
                f"{c}_missing"
            )
            for c in columns
        ],
    ]
