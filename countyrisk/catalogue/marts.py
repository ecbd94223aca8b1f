"""Queries: aggregations, windows, rankings, sets, cleaning jobs, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import display, fips, names
from ..operators import allocate, checks, dedupe, ranking, rollups
from ..plans import gold, incremental, profiles, quality, serving, silver
from ..session import scratch_dir
from ..sinks import commits, tables
from ..sources import files
from . import adapters
from .registry import query
from .workspace import RAW_SPLIT, WINDOW, Workspace

YEAR = 1998
COUNTY = "04004"
_CLAIMS_OUT = list(schemas.CLAIM_MEASURES.values())
_EVENTS_OUT = list(schemas.EVENT_FEATURES)
_RANK = ", ".join(ranking.RANK_COLUMNS)


def _rounded(df: DataFrame, columns, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- aggregations -----------------------------------------------------------------------


@query("ag01_hazard_rollup", f"SELECT {', '.join(schemas.SUMMARY_COLUMNS)} FROM summary")
def _(w: Workspace) -> DataFrame:
    return rollups.events_by_hazard(w.events(), WINDOW)


@query("ag02_event_county_year", f"SELECT county_fips, year, {', '.join(_EVENTS_OUT)} FROM noaa_county_year")
def _(w: Workspace) -> DataFrame:
    return rollups.events_by_county_year(w.events(), WINDOW)


@query(
    "ag03_mean_of_means",
    "SELECT county_fips, year, noaa_event_count, noaa_total_fatalities, noaa_total_injuries, round(noaa_avg_property_damage, 4) AS noaa_avg_property_damage FROM noaa_rollup",
)
def _(w: Workspace) -> DataFrame:
    return _rounded(rollups.summary_by_county_year(w.summary_lenient()), ["noaa_avg_property_damage"])


@query(
    "ag04_hazard_group_rollup",
    "SELECT s.county_fips, s.year, m.hazard_group, cast(sum(event_count) AS BIGINT) AS event_count, cast(sum(total_fatalities) AS BIGINT) AS total_fatalities, "
    "cast(sum(total_injuries) AS BIGINT) AS total_injuries, round(avg(avg_property_damage), 4) AS avg_property_damage "
    "FROM summary s LEFT JOIN type_map m ON s.hazard_type = m.event_type GROUP BY 1, 2, 3",
)
def _(w: Workspace) -> DataFrame:
    return _rounded(rollups.summary_by_group(w.summary(), w.type_map()), ["avg_property_damage"])


@query("ag05_weighted_allocation", f"SELECT county_fips, year, {', '.join(_CLAIMS_OUT)}, fema_declaration_count FROM fema_county_year")
def _(w: Workspace) -> DataFrame:
    return allocate.allocate_by_zip(w.claims(), w.declarations(), w.crosswalk(), WINDOW)


@query(
    "ag05_weighted_allocation_decimal",
    f"SELECT county_fips, year, {', '.join(_CLAIMS_OUT)}, fema_declaration_count FROM fema_county_year",
)
def _(w: Workspace) -> DataFrame:
    return allocate.allocate_by_zip(w.claims(), w.declarations(), w.crosswalk(), WINDOW, "decimal(18,4)")


@query(
    "ag06_equal_allocation",
    "SELECT county_fips, year, " + ", ".join(f"round({c}, 4) AS {c}" for c in _CLAIMS_OUT) + " FROM equal_shares",
)
def _(w: Workspace) -> DataFrame:
    return _rounded(allocate.allocate_equally(w.claims(), w.declarations()), _CLAIMS_OUT)


@query("ag07_distinct_disasters", "SELECT county_fips, year, count(DISTINCT disasternumber) AS disasters FROM county_map GROUP BY 1, 2")
def _(w: Workspace) -> DataFrame:
    county_map = allocate.disaster_county_map(w.declarations())
    return county_map.groupBy("county_fips", "year").agg(F.count_distinct("disasternumber").alias("disasters"))


@query("ag08_claims_by_disaster", f"SELECT disasternumber, {', '.join(schemas.CLAIM_MEASURES)} FROM claims_by_disaster")
def _(w: Workspace) -> DataFrame:
    return allocate.claims_by_disaster(w.claims())


@query("ag09_declarations_by_county_year", "SELECT county_fips, year, fema_declaration_count FROM decls_county_year")
def _(w: Workspace) -> DataFrame:
    return rollups.declarations_by_county_year(w.declarations())


@query("ag10_max_as_any_value", "SELECT county_fips, max(state) AS state, max(county_name) AS county_name FROM census_years c JOIN scores s USING (county_fips) GROUP BY 1")
def _(w: Workspace) -> DataFrame:
    rows = w.census_years().join(w.scores(), "county_fips")
    return rows.groupBy("county_fips").agg(F.max("state").alias("state"), F.max("county_name").alias("county_name"))


@query("ag11_duplicate_groups", "SELECT event_id, episode_id, count(*) AS cnt FROM keyed_events GROUP BY 1, 2 HAVING count(*) > 1")
def _(w: Workspace) -> DataFrame:
    return checks.duplicate_groups(silver.keyed_events(w.raw("events")), ("event_id", "episode_id"))


@query(
    "ag12_conditional_percentage",
    "SELECT year, 100.0 * sum(CASE WHEN noaa_event_count = 0 THEN 1 ELSE 0 END) / count(*) AS pct_noaa_zero FROM mart GROUP BY year",
)
def _(w: Workspace) -> DataFrame:
    return w.mart().groupBy("year").agg(checks.pct(ranking.no_events()).alias("pct_noaa_zero"))


@query(
    "ag13_conditional_median",
    "SELECT year, quantile_disc(nri_risk_score, 0.5) FILTER (noaa_event_count > 0) AS median_nri_noaa_pos FROM mart GROUP BY year",
)
def _(w: Workspace) -> DataFrame:
    return serving.year_kpis(w.mart(), 100000).select("year", "median_nri_noaa_pos")


@query(
    "ag14_null_rates",
    "SELECT avg(CASE WHEN stcofips IS NULL OR trim(stcofips) = '' THEN 1.0 ELSE 0.0 END) AS stcofips_null_rate, "
    "avg(CASE WHEN risk_score IS NULL OR trim(risk_score) = '' THEN 1.0 ELSE 0.0 END) AS risk_score_null_rate FROM raw_nri",
)
def _(w: Workspace) -> DataFrame:
    return checks.null_rates(names.normalize_columns(w.raw("nri")), ["stcofips", "risk_score", "absent"])


@query(
    "ag15_span_and_totals",
    "SELECT county_fips, min(year) AS first_year, max(year) AS last_year, cast(sum(noaa_event_count) AS BIGINT) AS events, sum(fema_valid_registrations) AS registrations FROM mart GROUP BY 1",
)
def _(w: Workspace) -> DataFrame:
    return w.mart().groupBy("county_fips").agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.sum("noaa_event_count").alias("events"),
        F.sum("fema_valid_registrations").alias("registrations"),
    )


@query("ag16_top_by_mean", "SELECT county_fips, avg(noaa_event_count) AS avg_events FROM mart GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10")
def _(w: Workspace) -> DataFrame:
    return ranking.top_by_mean(w.mart(), "noaa_event_count", "avg_events", 10)


@query(
    "ag17_legend_range",
    "SELECT min(v) AS low, quantile_cont(v, 0.5) AS median, max(v) AS high FROM (SELECT cast(noaa_event_count AS DOUBLE) AS v FROM mart)",
)
def _(w: Workspace) -> DataFrame:
    return ranking.metric_range(w.mart(), "noaa_event_count")


@query(
    "ag17_price_median",
    "SELECT l_linenumber, quantile_cont(cast(l_extendedprice AS DOUBLE), 0.5) AS median, count(DISTINCT l_extendedprice) > 10000 AS more_than_the_sketch "
    "FROM lineitem WHERE l_linenumber <= 2 GROUP BY l_linenumber",
)
def _(w: Workspace) -> DataFrame:
    """Medians over more values than the sketch holds, two line numbers apart."""
    lines = w.table("lineitem")

    def one(number: int) -> DataFrame:
        own = lines.filter(F.col("l_linenumber") == number)
        median = ranking.exact_median(own, F.col("l_extendedprice")).scalar()
        many = F.count_distinct("l_extendedprice") > ranking.SKETCH
        return own.groupBy("l_linenumber").agg(many.alias("more_than_the_sketch")).select("l_linenumber", median.alias("median"), "more_than_the_sketch")

    return one(1).unionByName(one(2))


@query(
    "ag18_match_rate",
    "SELECT count(*) AS claim_disaster_cnt, count(d.disasternumber) AS matched_disaster_cnt, 1.0 * count(d.disasternumber) / count(*) AS match_rate "
    "FROM (SELECT DISTINCT disasternumber FROM claims WHERE disasternumber IS NOT NULL) c LEFT JOIN (SELECT DISTINCT disasternumber FROM declarations) d USING (disasternumber)",
)
def _(w: Workspace) -> DataFrame:
    return quality.claims_match(w.claims(), w.declarations()).select(
        "claim_disaster_cnt", "matched_disaster_cnt", "match_rate"
    )


@query("ag19_group_by_ordinals", "SELECT hazard_type, year, cast(sum(event_count) AS BIGINT) AS events FROM summary GROUP BY 1, 2")
def _(w: Workspace) -> DataFrame:
    return w.spark.sql(
        "SELECT hazard_type, year, sum(event_count) AS events FROM {summary} GROUP BY 1, 2", summary=w.summary()
    )


# --- windows ------------------------------------------------------------------------------


@query(
    "wn1_latest_per_county",
    "SELECT county_fips, county_name, acs_year, population_total FROM census_years "
    "QUALIFY row_number() OVER (PARTITION BY county_fips ORDER BY acs_year DESC, county_name NULLS FIRST, population_total NULLS FIRST) = 1",
)
def _(w: Workspace) -> DataFrame:
    return dedupe.latest_per_key(w.census_years(), "county_fips", "acs_year")


@query(
    "wn2_latest_name",
    "SELECT county_fips, county_name FROM census_years QUALIFY row_number() OVER (PARTITION BY county_fips ORDER BY acs_year DESC, county_name) = 1",
)
def _(w: Workspace) -> DataFrame:
    return gold.census_latest_name(w.census_years())


def _trailing(n: int) -> str:
    over = f"OVER (PARTITION BY county_fips ORDER BY year ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (
        "SELECT county_fips, year, cast(noaa_event_count AS DOUBLE) AS noaa_event_count, fema_valid_registrations, fema_total_damage, nri_risk_score, "
        f"avg(cast(noaa_event_count AS DOUBLE)) {over} AS noaa_events_roll{n}, avg(fema_valid_registrations) {over} AS fema_regs_roll{n}, "
        f"avg(fema_total_damage) {over} AS fema_damage_roll{n} FROM mart"
    )


def _trailing_query(n: int) -> None:
    @query(f"wn3_trailing_mean_{n}", _trailing(n))
    def _(w: Workspace) -> DataFrame:
        return ranking.trailing_means(w.mart(), n)


for _n in (3, 5, 7):
    _trailing_query(_n)


@query(
    "wn4_latest_snapshot",
    "SELECT county_fips, year, nri_risk_score, noaa_event_count, fema_valid_registrations, fema_total_damage FROM mart "
    "QUALIFY row_number() OVER (PARTITION BY county_fips ORDER BY year DESC) = 1",
)
def _(w: Workspace) -> DataFrame:
    return serving.county_snapshot(w.mart())


_WN_SIZE = (
    "(SELECT county_fips, year, cast(noaa_event_count AS DOUBLE) AS v, (SELECT max(noaa_event_count) FROM mart) AS top FROM mart)"
)


@query("wn5_scaled_radius", f"SELECT county_fips, year, CASE WHEN top <= 0 THEN 25000.0 ELSE 2000.0 + 38000.0 * (v / top) END AS radius FROM {_WN_SIZE}")
def _(w: Workspace) -> DataFrame:
    top = ranking.largest(w.mart(), "noaa_event_count")
    return w.mart().select("county_fips", "year", display.point_radius("noaa_event_count", top).alias("radius"))


@query(
    "wn6_scaled_colour",
    f"SELECT county_fips, year, c AS colour_index, 255 - least(c, 200) AS blue FROM (SELECT *, cast(trunc(greatest(50.0, least(230.0, 50.0 + 180.0 * (v / top)))) AS INT) AS c FROM {_WN_SIZE})",
)
def _(w: Workspace) -> DataFrame:
    top = ranking.largest(w.mart(), "noaa_event_count")
    coloured = w.mart().withColumn("colour_index", display.point_colour_index("noaa_event_count", top))
    return coloured.select("county_fips", "year", "colour_index", display.point_colour("colour_index")[2].alias("blue"))


@query(
    "wn7_highlight_radius",
    f"SELECT county_fips, year, least(greatest(1.4 * (2000.0 + 38000.0 * (v / top)), 4000.0), 60000.0) AS radius_sel FROM {_WN_SIZE} WHERE county_fips = '{COUNTY}'",
)
def _(w: Workspace) -> DataFrame:
    top = ranking.largest(w.mart(), "noaa_event_count")
    chosen = w.mart().filter(F.col("county_fips") == fips.user_fips(F.lit("4004")))
    radius = display.point_radius("noaa_event_count", top)
    return chosen.select("county_fips", "year", display.highlight_radius(radius).alias("radius_sel"))


# --- rankings -----------------------------------------------------------------------------


def _ranking_query(name: str, mode: str, order: str) -> None:
    @query(name, f"SELECT {_RANK} FROM mart WHERE year = {YEAR} ORDER BY {order}, county_fips LIMIT 200")
    def _(w: Workspace) -> DataFrame:
        return ranking.rank_counties(w.mart(), mode, YEAR, 200)


_ranking_query("tk01_structural", "structural", "nri_risk_score DESC NULLS LAST")
_ranking_query("tk02_frequency", "frequency", "noaa_event_count DESC, fema_valid_registrations DESC")
_ranking_query("tk03_impact", "impact", "fema_total_damage DESC, fema_valid_registrations DESC")
_ranking_query("tk04_outcomes", "outcomes", "fema_valid_registrations DESC, fema_total_damage DESC")

_INTENSITY = "round(fema_valid_registrations / nullif(cast(noaa_event_count AS DOUBLE), 0.0), {d}) AS claims_per_event"


@query(
    "tk05_claim_intensity",
    f"SELECT county_fips, year, fema_valid_registrations, noaa_event_count, {_INTENSITY.format(d=2)} FROM mart WHERE year = {YEAR} "
    "ORDER BY claims_per_event DESC NULLS LAST, county_fips LIMIT 25",
)
def _(w: Workspace) -> DataFrame:
    return ranking.claim_intensity(w.mart(), YEAR, YEAR, 25)


@query(
    "tk06_quiet_but_risky",
    f"SELECT {_RANK} FROM mart WHERE year = {YEAR} AND noaa_event_count = 0 ORDER BY nri_risk_score DESC NULLS LAST, fema_valid_registrations DESC, county_fips LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    return ranking.quiet_but_risky(w.mart(), YEAR, 50)


@query(
    "tk07_hazard_breakdown",
    "SELECT hazard_type, hazard_category, event_count, total_fatalities, total_injuries, avg_property_damage FROM summary "
    f"WHERE county_fips = '{COUNTY}' AND year = {YEAR} ORDER BY event_count DESC, hazard_type, hazard_category LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    return ranking.hazard_breakdown(w.summary(), "4004", YEAR, 50)


@query(
    "tk08_filter_after_rank",
    f"SELECT * FROM (SELECT {_RANK} FROM mart WHERE year = {YEAR} ORDER BY fema_total_damage DESC, fema_valid_registrations DESC, county_fips LIMIT 400) "
    "WHERE noaa_event_count = 0 ORDER BY fema_total_damage DESC, fema_valid_registrations DESC, county_fips LIMIT 20",
)
def _(w: Workspace) -> DataFrame:
    order = [F.desc("fema_total_damage"), F.desc("fema_valid_registrations"), F.asc("county_fips")]
    return ranking.ranked_view(ranking.rank_counties(w.mart(), "impact", YEAR, 400), True, 20, order)


@query(
    "tk09_detail_sample",
    "SELECT county_fips, year, noaa_event_count, fema_valid_registrations FROM mart WHERE nri_risk_score IS NULL "
    "ORDER BY noaa_event_count DESC, fema_valid_registrations DESC, county_fips, year LIMIT 100",
)
def _(w: Workspace) -> DataFrame:
    unscored = w.mart().filter("nri_risk_score IS NULL").select(
        "county_fips", "year", "noaa_event_count", "fema_valid_registrations"
    )
    return ranking.top(unscored, ["noaa_event_count", "fema_valid_registrations"], 100, ["county_fips", "year"])


@query("tk10_directory", "SELECT county_fips, county_name, state FROM centroids ORDER BY state, county_name, county_fips")
def _(w: Workspace) -> DataFrame:
    return serving.directory(w.centroids())


@query(
    "tk11_violation_sample",
    "SELECT county_fips, year, margin FROM (SELECT county_fips, year, noaa_event_count - 5 AS margin FROM mart) WHERE margin < 0 ORDER BY county_fips, year LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    shifted = w.mart().select("county_fips", "year", (F.col("noaa_event_count") - 5).alias("margin"))
    return checks.violations(shifted, ["margin"], 50, ["county_fips", "year"])


# --- sets ---------------------------------------------------------------------------------


@query("st1_union_distinct", "SELECT county_fips, year FROM noaa_county_year UNION SELECT county_fips, year FROM fema_county_year")
def _(w: Workspace) -> DataFrame:
    by_event = rollups.events_by_county_year(w.events(), WINDOW).select("county_fips", "year")
    by_claim = allocate.allocate_by_zip(w.claims(), w.declarations(), w.crosswalk(), WINDOW)
    return by_event.union(by_claim.select("county_fips", "year")).distinct()


@query(
    "st2_union_all_by_name",
    "SELECT tenure, count(*) AS n, count(totaldamage) AS damages FROM claims_union GROUP BY tenure",
)
def _(w: Workspace) -> DataFrame:
    owners = names.project_to(names.normalize_columns(w.raw("owners")).withColumn("tenure", F.lit("owner")), schemas.CLAIMS)
    renters = names.project_to(names.normalize_columns(w.raw("renters")).withColumn("tenure", F.lit("renter")), schemas.CLAIMS)
    both = owners.unionByName(renters)
    return both.groupBy("tenure").agg(
        F.count("*").alias("n"), F.count(F.col("totaldamage").try_cast("double")).alias("damages")
    )


@query("st3_distinct_disaster_years", "SELECT disasternumber, state, year FROM decl_years")
def _(w: Workspace) -> DataFrame:
    return allocate.disaster_years(w.declarations(), WINDOW)


@query("st4_dedupe", "SELECT event_id, episode_id, run_dt, begin_date_time, damage_property FROM uniq_raw")
def _(w: Workspace) -> DataFrame:
    rows = dedupe.dedupe(silver.keyed_events(w.raw("events")), ("event_id", "episode_id"))
    return rows.select("event_id", "episode_id", "run_dt", "begin_date_time", "damage_property")


@query(
    "st5_dedupe_fallback_key",
    "SELECT disasternumber, county_fips, incidenttype, declarationtype, declarationdate FROM declarations QUALIFY row_number() OVER "
    "(PARTITION BY disasternumber, county_fips, incidenttype, declarationtype ORDER BY declarationdate NULLS FIRST, fydeclared NULLS FIRST) = 1",
)
def _(w: Workspace) -> DataFrame:
    columns = [*silver.DECLARATION_FALLBACK_KEY, "declarationdate", "fydeclared"]
    rows = dedupe.dedupe_with_fallback(w.declarations().select(*columns), ("id",), silver.DECLARATION_FALLBACK_KEY)
    return rows.drop("fydeclared")


@query(
    "st6_surrogate_key",
    "SELECT event_id, sha256(concat_ws('||', event_id, episode_id, category)) AS row_key, "
    "sha256(concat_ws('||', event_id, episode_id, coalesce(category, '~'))) AS row_key_nulls FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    events = names.normalize_columns(w.raw("events"))
    columns = ("event_id", "episode_id", "category")
    keyed = dedupe.surrogate_key(events, columns, "row_key")
    return dedupe.surrogate_key(keyed, columns, "row_key_nulls", "~").select("event_id", "row_key", "row_key_nulls")


# --- cleaning jobs ---------------------------------------------------------------------------

_EVENT_OUT = (
    "event_id, episode_id, state, state_fips, cz_fips, event_type, category, year, begin_date_time, end_date_time, "
    "injuries_direct, deaths_direct, damage_property, magnitude, county_fips, county_fips_raw_candidate, cz_name_norm, cz_name_compact, county_fips_mapping_method"
)


@query("sv1_events_clean", f"SELECT {_EVENT_OUT} FROM events_clean")
def _(w: Workspace) -> DataFrame:
    return w.events().select(*_EVENT_OUT.split(", "))


_INCREMENTAL_OUT = "event_id, episode_id, state, state_fips, event_type, year, begin_date_time, injuries_direct, county_fips, cz_name_norm, county_fips_mapping_method"


@query("sv1_incremental_run", f"SELECT {_INCREMENTAL_OUT} FROM events_clean")
def _(w: Workspace) -> DataFrame:
    """Reports landed by year, a file from each task that reads rows of it, and a rest: a run without 1998 and the rest, one with them."""
    root, landed = scratch_dir(w.spark, "incremental"), scratch_dir(w.spark, "incremental-landing")
    part = F.regexp_extract("YEAR", r"(\d{4})", 1)
    late = part.isin("1998", "")
    for run_id, rows in (("r1", ~late), ("r2", late)):
        keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "compression": "gzip"}
        with files.split_size(w.spark, RAW_SPLIT):
            new = tables.in_place(w.raw("events").withColumn("part", part).filter(rows), "part")
            new.write.mode("append").partitionBy("part").options(**keep).csv(landed)
        done = incremental.update_events(w.spark, landed, root, w.counties(), run_id)
    if not done.read or 1998 not in done.years:
        raise AssertionError(f"the second run cleaned {done.read}")
    return incremental.events(w.spark, root).select(*_INCREMENTAL_OUT.split(", "))


@query("sv1_events_unresolved", f"SELECT {_EVENT_OUT} FROM classified WHERE county_fips_mapping_method = 'unresolved'")
def _(w: Workspace) -> DataFrame:
    return w.events("unresolved").select(*_EVENT_OUT.split(", "))


@query("sv1_events_non_county", f"SELECT {_EVENT_OUT} FROM classified WHERE county_fips_mapping_method = 'non_county_zone'")
def _(w: Workspace) -> DataFrame:
    return w.events("non_county").select(*_EVENT_OUT.split(", "))


@query("sv2_declarations_clean", f"SELECT {', '.join(adapters.columns('declarations'))}, county_fips FROM declarations")
def _(w: Workspace) -> DataFrame:
    return silver.clean_declarations(w.raw("declarations"))


@query("sv3_claims_clean", f"SELECT {', '.join(schemas.CLAIMS)} FROM claims")
def _(w: Workspace) -> DataFrame:
    return silver.clean_claims(w.raw("owners"), w.raw("renters"))


@query("sv4_scores_clean", f"SELECT {', '.join(adapters.columns('nri'))}, county_fips FROM scores")
def _(w: Workspace) -> DataFrame:
    return silver.clean_scores(w.raw("nri"))[0]


@query("sv4_scores_unresolved", f"SELECT {', '.join(adapters.columns('nri'))}, county_fips FROM scores_unresolved")
def _(w: Workspace) -> DataFrame:
    return silver.clean_scores(w.raw("nri"))[1]


@query("sv5_census_clean", f"SELECT county_fips, county_name, {', '.join(schemas.CENSUS_MEASURES)}, acs_year FROM census")
def _(w: Workspace) -> DataFrame:
    return silver.clean_census(w.acs())


@query("sv6_crosswalk_clean", "SELECT zip5, county_fips, tot_ratio, year FROM crosswalk")
def _(w: Workspace) -> DataFrame:
    return silver.clean_crosswalk(w.raw("crosswalk"))


@query(
    "sv7_job_metrics",
    "SELECT 'fema_disaster_declarations_clean' AS dataset, (SELECT count(*) FROM raw_declarations) AS bronze_rows, count(*) AS silver_rows, "
    "avg(CASE WHEN disasternumber IS NULL THEN 1.0 ELSE 0.0 END) AS disasternumber_null_rate, avg(CASE WHEN county_fips IS NULL THEN 1.0 ELSE 0.0 END) AS county_fips_null_rate FROM declarations",
)
def _(w: Workspace) -> DataFrame:
    path = scratch_dir(w.spark, "sv7")
    return silver.job_metrics(
        "fema_disaster_declarations_clean",
        w.raw("declarations"),
        silver.clean_declarations,
        ("disasternumber", "county_fips"),
        lambda rows: tables.write_plain(rows, path),
    )


@query(
    "sv7_stored_profiles",
    "SELECT n AS name, count(*) AS rows, count(*) - count(v) AS nulls, min(v) AS low, max(v) AS high FROM (SELECT 'county_fips' AS n, county_fips AS v FROM summary "
    "UNION ALL SELECT 'hazard_category', hazard_category FROM summary UNION ALL SELECT 'year', CAST(CAST(year AS DOUBLE) AS VARCHAR) FROM summary) GROUP BY n",
)
def _(w: Workspace) -> DataFrame:
    """Profiles of a table whose year 1998 was replaced: the second run reads that year only."""
    root, store = scratch_dir(w.spark, "sv7-table"), scratch_dir(w.spark, "sv7-profiles")
    columns = ("county_fips", "hazard_category", "year")
    for rows in (w.summary().withColumn("county_fips", F.when(F.col("year") != 1998, F.col("county_fips"))), w.summary().filter("year = 1998")):
        folders = commits.stage(rows, root, ("year",))
        years = {commits.partition_of(f)["year"] for f in folders}
        commits.commit(w.spark, root, lambda now: commits.replaced(now, folders, lambda part: part["year"] in years, rows.schema, {}))  # noqa: B023
        new = profiles.update_profiles(w.spark, root, store, columns)
    if len(new) != 1:
        raise AssertionError(f"the second run profiled {new}")
    return profiles.table_profile(w.spark, root, store).select("name", "rows", "nulls", "low", "high")


# --- marts -------------------------------------------------------------------------------------


@query("gd01_hazard_event_summary", f"SELECT {', '.join(schemas.SUMMARY_COLUMNS)} FROM summary")
def _(w: Workspace) -> DataFrame:
    return gold.hazard_event_summary(w.events(), WINDOW)


@query("gd02_risk_feature_mart", f"SELECT {', '.join(schemas.FEATURE_MART_COLUMNS)} FROM mart")
def _(w: Workspace) -> DataFrame:
    return w.build_mart()


@query("gd03_hazard_event_summary_lenient", f"SELECT {', '.join(schemas.SUMMARY_COLUMNS)} FROM summary_lenient")
def _(w: Workspace) -> DataFrame:
    return gold.hazard_event_summary_lenient(w.events())


_ROUNDED = ("noaa_avg_property_damage", *_CLAIMS_OUT)


@query(
    "gd04_risk_feature_mart_scaffold",
    "SELECT " + ", ".join(f"round({c}, 4) AS {c}" if c in _ROUNDED else c for c in schemas.FEATURE_MART_COLUMNS) + " FROM scaffold",
)
def _(w: Workspace) -> DataFrame:
    return _rounded(w.build_scaffold(), _ROUNDED)


@query("gd05_county_dim", "SELECT county_fips, county_name, state, state_fips, county_name_normalized FROM dim")
def _(w: Workspace) -> DataFrame:
    return gold.county_dim(w.scores(), w.census())


@query("gd06_years_in_scope", "SELECT year FROM years")
def _(w: Workspace) -> DataFrame:
    return rollups.years_in_scope(w.events(), w.declarations())


@query("gd06_years_in_scope_window", "SELECT year FROM years WHERE year BETWEEN 1996 AND 2000")
def _(w: Workspace) -> DataFrame:
    return rollups.years_in_scope(w.events(), w.declarations(), WINDOW)


@query("gd07_county_year_universe", "SELECT county_fips, year FROM universe")
def _(w: Workspace) -> DataFrame:
    return gold.county_year_universe(w.dim(), w.years())


@query("gd08_hazard_type_map", "SELECT event_type, hazard_group, hazard_subgroup FROM type_map")
def _(w: Workspace) -> DataFrame:
    return w.type_map()


@query(
    "gd09_noaa_county_year",
    "SELECT county_fips, year, noaa_event_count, noaa_total_fatalities, noaa_total_injuries FROM noaa_rollup",
)
def _(w: Workspace) -> DataFrame:
    return rollups.summary_by_county_year(w.summary_lenient()).drop("noaa_avg_property_damage")


@query("gd10_nri_county", "SELECT county_fips, nri_risk_score, nri_eal_score, nri_sovi_score, nri_resl_score FROM nri_county")
def _(w: Workspace) -> DataFrame:
    return gold.county_scores(w.scores())


@query("gd11_census_county_latest", f"SELECT county_fips, acs_year, {', '.join(schemas.CENSUS_MEASURES)} FROM census")
def _(w: Workspace) -> DataFrame:
    return gold.census_latest(w.census(), sane_only=False)


@query("gd12_disaster_county_map", "SELECT disasternumber, county_fips, year FROM county_map")
def _(w: Workspace) -> DataFrame:
    return allocate.disaster_county_map(w.declarations())


@query("gd12_disaster_county_counts", "SELECT disasternumber, year, county_cnt FROM county_counts")
def _(w: Workspace) -> DataFrame:
    return allocate.disaster_county_counts(allocate.disaster_county_map(w.declarations()))


@query(
    "gd12_disaster_fan_out",
    "SELECT disasternumber, state, count(*) AS fiscal_years FROM decl_years GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(w: Workspace) -> DataFrame:
    return allocate.disaster_fan_out(w.declarations(), WINDOW)


@query("gd14_feature_defaults", "SELECT county_fips, year, " + ", ".join((*_EVENTS_OUT, *schemas.CLAIM_FEATURES, "population_total")) + " FROM mart")
def _(w: Workspace) -> DataFrame:
    return w.mart().select("county_fips", "year", *_EVENTS_OUT, *schemas.CLAIM_FEATURES, "population_total")
