"""Raw data to published marts in one call; scheduling is left to the user."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Paths, YearWindow
from ..functions import fips
from ..operators import allocate, checks, resolve, rollups
from ..sinks import commits, tables
from ..sources import files, landing
from . import gold, incremental, publish, quality, silver

# Folder of the storm reports that incremental runs keep.
EVENT_VERSIONS = "noaa_events_versions"
# Outcome -> table name of the cleaned storm reports.
EVENT_TABLES = {
    "valid": "noaa_events_clean",
    "unresolved": "noaa_events_clean_unresolved_county_fips",
    "non_county": "noaa_events_clean_non_county_zones",
}
SILVER_TABLES = (
    "fema_disaster_declarations_clean",
    "fema_claims_clean",
    "nri_scores_clean",
    "nri_scores_clean_unresolved_county_fips",
    "census_clean",
    "zip2county_xwalk_clean",
)


@dataclass(frozen=True)
class Raw:
    """The raw frames of a run, all columns strings."""

    events: DataFrame
    declarations: DataFrame
    owners: DataFrame
    renters: DataFrame
    nri: DataFrame
    acs: dict[str, DataFrame]
    crosswalk: DataFrame


def read_raw(spark: SparkSession, paths: Paths) -> Raw:
    text = lambda name, repeated=(): files.read_csv_text(spark, paths.bronze(name), repeated)
    return Raw(
        events=text("noaa/details", ("year",)),
        declarations=text("fema/disaster_declarations"),
        owners=text("fema/housing_assistance_owners"),
        renters=text("fema/housing_assistance_renters"),
        nri=text("nri/counties"),
        acs={t: text(f"census/acs5_2022_{t.upper()}", ("name",)) for t in silver.CENSUS_CELLS},
        crosswalk=files.read_crosswalk(spark, paths.bronze("reference/zip2county_master_xwalk")),
    )


def write_events(matched: DataFrame, path: str) -> Observation:
    """Valid, unresolved and non-county rows in one pass, below ``outcome=…/year=…``.

    ``matched`` is the frame of :func:`silver.matched_events`; it is typed where it is written. Each outcome is a table of its own at its folder. One job writes all three, so the
    classification neither runs three times nor has to be cached; the counts come from
    the same pass. The shuffle that drops the duplicates has dealt the rows evenly, so they are written where they lie.
    """
    seen = Observation("events")
    labelled = resolve.with_outcome(matched).observe(
        seen,
        *[F.count_if(F.col(resolve.OUTCOME) == o).alias(f"{o}_rows") for o in EVENT_TABLES],
        *silver.null_rate_metrics(("event_id", "episode_id", "county_fips")),
    )
    tables.write_partitioned(labelled, path, (resolve.OUTCOME, "year"), finish=silver.typed_events, deal=tables.in_place)
    return seen


def events_path(path: str, outcome: str = "valid") -> str:
    return f"{path}/{resolve.OUTCOME}={outcome}"


@dataclass(frozen=True)
class Landing:
    """An incremental run: the years it looks at, as :func:`countyrisk.sources.landing.year_scope` takes them.

    ``mode`` is ``backfill`` (files dated first to last) or ``monthly`` (the run's year plus ``offset``)."""

    mode: str
    first: int = 0
    last: int = 0
    offset: int = 0


def update_events(spark: SparkSession, paths: Paths, counties: DataFrame, run_id: str, run_dt: str, scope: Landing) -> dict:
    """Only the years whose landed files changed are cleaned and replaced; what was done, for the run log."""
    years = landing.year_scope(spark, scope.mode, run_dt, scope.first, scope.last, scope.offset)
    done = incremental.update_events(spark, paths.bronze("noaa/details"), paths.silver(EVENT_VERSIONS), counties, run_id, years)
    return {"version": done.commit.number, "years": done.years, "files_changed": len(done.changed), "files_read": len(done.read)}


def silver_events(spark: SparkSession, paths: Paths, outcome: str = "valid", scope: Landing | None = None) -> DataFrame:
    """Cleaned storm reports: of the versioned table in an incremental run, else of the plain one."""
    if scope is not None:
        return incremental.events(spark, paths.silver(EVENT_VERSIONS), outcome)
    return spark.read.parquet(events_path(paths.silver("noaa_events"), outcome))


def build_silver(
    spark: SparkSession, raw: Raw, paths: Paths, acs_year: int = 2022, run_id: str = "", run_dt: str = "", scope: Landing | None = None
) -> dict[str, dict]:
    """Clean and write every table; metrics per job come from the writes themselves."""
    metrics: dict[str, dict] = {}
    tables.write_plain(silver.county_reference(raw.nri), paths.silver("county_reference"))
    counties = spark.read.parquet(paths.silver("county_reference"))
    if scope is not None:
        metrics["events"] = update_events(spark, paths, counties, run_id, run_dt, scope)
    else:
        metrics["events"] = write_events(silver.matched_events(silver.keyed_events(raw.events), counties), paths.silver("noaa_events")).get

    def write(name: str, df: DataFrame, columns: tuple[str, ...], partition: str | None = None) -> None:
        seen = Observation(name)
        observed = df.observe(seen, *silver.null_rate_metrics(columns))
        if partition:
            tables.write_partitioned(observed, paths.silver(name), (partition,))
        else:
            tables.write_plain(observed, paths.silver(name))
        metrics[name] = seen.get

    write(
        "fema_disaster_declarations_clean",
        silver.clean_declarations(raw.declarations),
        ("disasternumber", "county_fips", "fydeclared"),
    )
    write("fema_claims_clean", silver.clean_claims(raw.owners, raw.renters), ("id", "disasternumber", "state", "county"))
    scores, quarantined = silver.clean_scores(raw.nri)
    write("nri_scores_clean", scores, ("county_fips", "nri_id", "risk_score"))
    write("nri_scores_clean_unresolved_county_fips", quarantined, ("nri_id",))
    write(
        "census_clean",
        silver.clean_census(raw.acs, acs_year),
        ("county_fips", "population_total", "median_household_income"),
    )
    write("zip2county_xwalk_clean", silver.clean_crosswalk(raw.crosswalk), ("zip5", "county_fips"), "year")
    return metrics


def register_silver(spark: SparkSession, paths: Paths, database: str = "default", scope: Landing | None = None) -> list[str]:
    """Views over the cleaned tables by name. An outcome without rows has no folder. The storm reports of
    an incremental run are views of the session, as a version is made of folders of several runs."""
    if scope is not None:
        for outcome, name in EVENT_TABLES.items():
            silver_events(spark, paths, outcome, scope).createOrReplaceTempView(name)
        return [*EVENT_TABLES.values(), *[tables.folder_view(spark, name, paths.silver(name), database) for name in SILVER_TABLES]]
    root = paths.silver("noaa_events")
    present = {r[0] for r in spark.read.parquet(root).select(resolve.OUTCOME).distinct().collect()}
    names = [
        tables.folder_view(spark, name, events_path(root, outcome), database)
        for outcome, name in EVENT_TABLES.items()
        if outcome in present
    ]
    return names + [tables.folder_view(spark, name, paths.silver(name), database) for name in SILVER_TABLES]


def build_gold(
    spark: SparkSession,
    paths: Paths,
    run_dt: str,
    window: YearWindow = YearWindow(),
    database: str = "default",
    raise_on_block: bool = False,
    scope: Landing | None = None,
) -> list[publish.Published]:
    """Both marts as versions, each checked before its view moves."""
    read = lambda name: spark.read.parquet(paths.silver(name))
    events = silver_events(spark, paths, scope=scope)
    claims, declarations = read("fema_claims_clean"), read("fema_disaster_declarations_clean")
    crosswalk, census, scores = read("zip2county_xwalk_clean"), read("census_clean"), read("nri_scores_clean")

    def published(name: str, df: DataFrame, suite) -> publish.Published:
        return publish.publish_version(df, name, run_dt, paths.gold(name, run_dt), suite, database, raise_on_block, paths.versions(name))

    first = published("hazard_event_summary", gold.hazard_event_summary(events, window), lambda t: quality.summary_suite(t, census))
    summary = spark.table(first.table)  # what was written, not its plan again
    universe = observed_universe(summary, claims, declarations, crosswalk, window)
    mart = gold.feature_mart(events, claims, declarations, crosswalk, census, scores, window)
    return [first, published("risk_feature_mart", mart, lambda t: quality.mart_suite(t, census, universe, window))]


def observed_universe(
    summary: DataFrame, claims: DataFrame, declarations: DataFrame, crosswalk: DataFrame, window: YearWindow
) -> DataFrame:
    """County-years the active mart must cover: those with an event or an allocated claim.

    Both come from the sources of the mart, not from the mart, so a lost one is missed."""
    claimed = allocate.allocate_by_zip(claims, declarations, crosswalk, window).filter(fips.sane_condition("county_fips"))
    return summary.select("county_fips", "year").union(claimed.select("county_fips", "year")).distinct()


def build_scaffold(
    spark: SparkSession, paths: Paths, run_dt: str, type_map: DataFrame, database: str = "default", raise_on_block: bool = False
) -> publish.Published:
    """The mart over every county and year, with the thirteen checks as its gate.

    The universe is written first: it is what the mart is checked against."""
    read = lambda name: spark.read.parquet(paths.silver(name))
    events = spark.read.parquet(events_path(paths.silver("noaa_events")))
    claims, declarations = read("fema_claims_clean"), read("fema_disaster_declarations_clean")
    census, scores = read("census_clean"), read("nri_scores_clean")
    dim, years = gold.county_dim(scores, census), rollups.years_in_scope(events, declarations)

    def stored(name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        path = paths.gold(name, run_dt)
        tables.write_partitioned(df, path, (partition,)) if partition else tables.write_plain(df, path)
        return spark.read.parquet(path)

    dim, years = stored("county_dim", dim), stored("years_in_scope", years)
    universe = stored("county_year_universe", gold.county_year_universe(dim, years), "year")
    summary = stored("hazard_event_summary_lenient", gold.hazard_event_summary_lenient(events), "year")
    mart = gold.feature_mart_scaffold(universe, summary, claims, declarations, census, scores)
    suite = lambda t: quality.legacy_suite(
        events, type_map, dim, years, universe, summary, t, claims, declarations, gold.county_scores(scores)
    )
    name = "risk_feature_mart_scaffold"
    return publish.publish_version(mart, name, run_dt, paths.gold(name, run_dt), suite, database, raise_on_block, paths.versions(name))


def open_current(spark: SparkSession, paths: Paths) -> list[str]:
    """Views ``<mart>_current`` of this session over the newest version of each mart that has one, from the
    commit logs alone: neither the session that promoted them nor a metastore is needed."""
    found = [mart for mart in publish.MARTS if commits.history(spark, paths.versions(mart))]
    return [commits.attach(spark, paths.versions(mart), f"{mart}_current") for mart in found]


def run_pipeline(
    spark: SparkSession,
    paths: Paths,
    run_id: str,
    run_dt: str,
    window: YearWindow = YearWindow(),
    database: str = "default",
    raise_on_block: bool = False,
    scope: Landing | None = None,
) -> str:
    """Raw checks, cleaning, marts, gate, promotion and run log. Gives the overall status.

    With a ``scope`` the storm reports are brought up to date instead of cleaned anew."""
    log_path = paths.ops("run_log")

    def log(layer: str, kind: str, name: str, payload: dict, status: str | None = None, block: bool = False) -> None:
        publish.append_log(
            publish.log_entry(spark, run_id, run_dt, layer, kind, name, payload, status, block), log_path
        )

    def gate(layer: str, suite: checks.Suite) -> None:
        results = checks.run_checks(spark, suite)
        status, blocked = publish.suite_verdict(results)
        log(layer, "quality", suite.name, {"results": [r.asDict() for r in results.collect()]}, status, blocked)
        publish.require_unblocked(publish.read_log(spark, log_path), layer, run_dt)

    raw = read_raw(spark, paths)
    log("bronze", "plan", "run", {"run_dt": run_dt, "window": [window.first, window.last]})
    gate("bronze", quality.bronze_events_suite(raw.events))

    metrics = build_silver(spark, raw, paths, run_id=run_id, run_dt=run_dt, scope=scope)
    register_silver(spark, paths, database, scope)
    log("silver", "metadata", "row_counts", metrics)
    gate("silver", quality.silver_events_suite(silver_events(spark, paths, scope=scope)))

    published = build_gold(spark, paths, run_dt, window, database, raise_on_block, scope)
    for p in published:
        log(
            "gold",
            "quality",
            p.mart,
            {"table": p.table, "promoted": p.promoted, "results": [r.asDict() for r in p.results.collect()]},
            p.status,
            p.blocked,
        )
    worst = max((p.status for p in published), key=("pass", "warn", "fail").index)
    log("gold", "health", "gold_health", {"marts": {p.mart: p.status for p in published}}, worst)
    log("gold", "summary", "run", {"run_dt": run_dt, "status": worst}, worst)
    return worst
