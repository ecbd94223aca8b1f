"""Queries: county keys, place names, resolution, filters, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fips, geonames, names
from ..operators import allocate, checks, keys, resolve, rollups
from ..plans import gold, serving, silver
from .oracle import blank, codes, compact, nname, sane, std, zip5
from .registry import query
from .workspace import WINDOW, Workspace


def _raw(w: Workspace, name: str) -> DataFrame:
    return names.normalize_columns(w.raw(name))


# --- keys ---------------------------------------------------------------------------


@query("geo01_standard_key", f"SELECT nri_id, {std('stcofips')} AS county_fips FROM raw_nri")
def _(w: Workspace) -> DataFrame:
    return keys.standardize(_raw(w, "nri").withColumnRenamed("stcofips", "county_fips")).select("nri_id", "county_fips")


@query(
    "geo02_sane_keys",
    f"SELECT id, county_fips FROM declarations WHERE {sane('county_fips')}",
)
def _(w: Workspace) -> DataFrame:
    return keys.keep_sane(w.declarations()).select("id", "county_fips")


@query(
    "geo03_keep_canonical",
    "SELECT id, county_fips FROM declarations WHERE county_fips IN (SELECT county_fips FROM scores)",
)
def _(w: Workspace) -> DataFrame:
    return keys.keep_canonical(w.declarations(), w.scores()).select("id", "county_fips")


@query("geo04_normal_name", f"SELECT event_id, {nname('cz_name')} AS name_norm FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return _raw(w, "events").select("event_id", geonames.normal_name("cz_name").alias("name_norm"))


@query("geo05_compact_name", f"SELECT event_id, {compact('cz_name')} AS name_compact FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return _raw(w, "events").select("event_id", geonames.compact_name("cz_name").alias("name_compact"))


@query("geo06_key_from_codes", f"SELECT id, {codes('fipsstatecode', 'fipscountycode')} AS county_fips FROM raw_declarations")
def _(w: Workspace) -> DataFrame:
    return _raw(w, "declarations").select(
        "id", fips.fips_from_codes("fipsstatecode", "fipscountycode").alias("county_fips")
    )


@query(
    "geo07_key_from_zone",
    f"SELECT event_id, cz_type, CASE WHEN upper(trim(cz_type)) = 'C' THEN {codes('state_fips', 'cz_fips')} END AS county_fips FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    return _raw(w, "events").select(
        "event_id", "cz_type", fips.fips_from_zone("state_fips", "cz_fips", "cz_type").alias("county_fips")
    )


@query(
    "geo08_recode_state",
    f"SELECT event_id, CASE WHEN lpad({blank('state_fips')}, 2, '0') = '99' THEN '72' ELSE lpad({blank('state_fips')}, 2, '0') END AS state_fips_norm FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    return _raw(w, "events").select("event_id", fips.recode_state("state_fips").alias("state_fips_norm"))


@query("geo09_zone_type", f"SELECT event_id, upper(trim({blank('cz_type')})) AS cz_type_norm FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return _raw(w, "events").select("event_id", fips.zone_type("cz_type").alias("cz_type_norm"))


@query(
    "geo10_raw_candidate",
    "SELECT event_id, episode_id, state_fips_norm, county_fips_raw_candidate, cz_name_norm, cz_name_compact FROM candidates",
)
def _(w: Workspace) -> DataFrame:
    return resolve.with_candidate_key(silver.unique_events(w.raw("events"))).select(
        "event_id", "episode_id", "state_fips_norm", "county_fips_raw_candidate", "cz_name_norm", "cz_name_compact"
    )


@query("geo11_canonical_counties", "SELECT county_fips, state_fips_norm, county_name_norm, county_name_compact FROM counties")
def _(w: Workspace) -> DataFrame:
    return silver.county_reference(w.raw("nri"))


def _lookup(w: Workspace, name: str) -> DataFrame:
    return resolve.unique_name_lookup(w.counties(), name, "county_fips")


@query("geo12_unique_names", "SELECT state_fips_norm, county_name_norm, county_fips FROM name_lookup")
def _(w: Workspace) -> DataFrame:
    return _lookup(w, "county_name_norm")


@query("geo13_unique_compact_names", "SELECT state_fips_norm, county_name_compact, county_fips FROM compact_lookup")
def _(w: Workspace) -> DataFrame:
    return _lookup(w, "county_name_compact")


@query(
    "geo14_resolution_cascade",
    "SELECT event_id, county_fips, county_fips_raw_candidate, county_fips_mapping_method FROM classified",
)
def _(w: Workspace) -> DataFrame:
    return silver.clean_events(w.raw("events"), w.counties()).select(
        "event_id", "county_fips", "county_fips_raw_candidate", resolve.METHOD
    )


@query(
    "geo15_outcome_split",
    "SELECT CASE county_fips_mapping_method WHEN 'non_county_zone' THEN 'non_county' WHEN 'unresolved' THEN 'unresolved' ELSE 'valid' END AS outcome, "
    "count(*) AS n, count(county_fips) AS keyed FROM classified GROUP BY 1",
)
def _(w: Workspace) -> DataFrame:
    parts = resolve.split_outcomes(silver.clean_events(w.raw("events"), w.counties()))
    out = None
    for outcome, rows in parts.items():
        counted = rows.groupBy(F.lit(outcome).alias("outcome")).agg(
            F.count("*").alias("n"), F.count("county_fips").alias("keyed")
        )
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "geo16_score_quarantine",
    "SELECT nri_id, county_fips, false AS sane FROM scores_unresolved UNION ALL SELECT nri_id, county_fips, true FROM scores",
)
def _(w: Workspace) -> DataFrame:
    good, bad = silver.clean_scores(w.raw("nri"))
    columns = ("nri_id", "county_fips")
    return good.select(*columns, F.lit(True).alias("sane")).unionByName(bad.select(*columns, F.lit(False).alias("sane")))


@query("geo17_padded_zip", "SELECT zip, year, lpad(zip, 5, '0') AS zip5 FROM raw_crosswalk")
def _(w: Workspace) -> DataFrame:
    return w.raw("crosswalk").select("zip", "year", fips.padded_zip("zip").alias("zip5"))


@query("geo18_zip_from_text", f"SELECT id, tenure, zipcode, {zip5('zipcode')} AS zip5 FROM claims")
def _(w: Workspace) -> DataFrame:
    return w.claims().select("id", "tenure", "zipcode", fips.zip_from_text("zipcode").alias("zip5"))


@query(
    "geo19_name_without_state",
    r"SELECT c.county_fips, s.state, trim(regexp_replace(c.county_name, concat(',\s*', s.state, '$'), '')) AS county_name "
    r"FROM scores s JOIN census c USING (county_fips) WHERE regexp_matches(c.county_name, concat(',\s*', s.state, '$'))",
)
def _(w: Workspace) -> DataFrame:
    named = w.scores().join(w.census(), "county_fips")
    short = geonames.without_state_suffix("county_name", "state")
    return named.select("county_fips", "state", short.alias("county_name")).filter("county_name IS NOT NULL")


@query(
    "geo20_name_override",
    "SELECT county_fips, name AS county_name FROM dim_names",
)
def _(w: Workspace) -> DataFrame:
    base = w.scores().select(
        "county_fips", "state", geonames.without_listed_state(geonames.without_last_part("county")).alias("nri_name")
    ).join(gold.census_latest_name(w.census()), "county_fips", "left")
    census = geonames.without_state_suffix("county_name", "state")
    return base.select("county_fips", geonames.display_name("county_fips", "nri_name", census).alias("county_name"))


@query(
    "geo21_connecticut_names",
    r"SELECT nri_id, CASE WHEN state = 'Connecticut' THEN trim(regexp_replace(cut, ' +Connecticut$', '')) ELSE cut END AS county_name, "
    r"lower(trim(CASE WHEN state = 'Connecticut' THEN trim(regexp_replace(cut, ' +Connecticut$', '')) ELSE cut END)) AS county_name_normalized FROM "
    r"(SELECT nri_id, state, trim(regexp_replace(regexp_replace(trim(regexp_replace(county, ',\s*[^,]+$', '')), ',\s*Connecticut$', ''), ',\s*Conneccticut$', '')) AS cut FROM raw_nri)",
)
def _(w: Workspace) -> DataFrame:
    shown = geonames.without_trailing_state(geonames.without_listed_state(geonames.without_last_part("county")), "state")
    return _raw(w, "nri").select(
        "nri_id", shown.alias("county_name"), geonames.search_form(shown).alias("county_name_normalized")
    )


@query(
    "geo22_state_digits",
    f"SELECT nri_id, CASE WHEN trim(statefips) <> '' THEN lpad(regexp_replace(statefips, '[^0-9]', '', 'g'), 2, '0') END AS state_fips FROM raw_nri",
)
def _(w: Workspace) -> DataFrame:
    return _raw(w, "nri").select("nri_id", fips.state_digits("statefips").alias("state_fips"))


@query(
    "geo23_user_key",
    "SELECT county_fips, CASE WHEN length(d) > 5 THEN d ELSE lpad(d, 5, '0') END AS user_fips, "
    "regexp_full_match(CASE WHEN length(d) > 5 THEN d ELSE lpad(d, 5, '0') END, '[0-9]{5}') AS valid "
    "FROM (SELECT county_fips, regexp_replace(county_fips, '[^0-9]', '', 'g') AS d FROM (SELECT CASE WHEN lat IS NULL THEN 'none' ELSE county_fips END AS county_fips FROM raw_centroids))",
)
def _(w: Workspace) -> DataFrame:
    key = fips.user_fips("county_fips")
    typed = w.raw("centroids").select(F.when(F.col("lat").isNull(), "none").otherwise(F.col("county_fips")).alias("county_fips"))
    return typed.select("county_fips", key.alias("user_fips"), fips.is_user_fips(key).alias("valid"))


@query("geo24_centroids", "SELECT county_fips, county_name, state, lat, lon FROM centroids")
def _(w: Workspace) -> DataFrame:
    return gold.county_centroids(w.raw("centroids"))


# --- filters --------------------------------------------------------------------------


@query("flt1_year_window", "SELECT event_id, year FROM events_clean WHERE year BETWEEN 1996 AND 2000")
def _(w: Workspace) -> DataFrame:
    return rollups.in_window(w.events(), WINDOW).select("event_id", "year")


@query("flt2_not_blank", "SELECT id, tenure, state, zipcode FROM claims WHERE state IS NOT NULL AND trim(state) <> '' AND zipcode IS NOT NULL")
def _(w: Workspace) -> DataFrame:
    return w.claims().filter("state IS NOT NULL AND trim(state) <> '' AND zipcode IS NOT NULL").select(
        "id", "tenure", "state", "zipcode"
    )


@query("flt3_top_match", "SELECT zip, year, county FROM raw_crosswalk WHERE top_match IN ('True', '1', 't')")
def _(w: Workspace) -> DataFrame:
    main = F.lower(F.trim("top_match")).isin("true", "t", "1")
    return w.raw("crosswalk").filter(main).select("zip", "year", "county")


@query("flt4_key_prefix", "SELECT id, county_fips FROM declarations WHERE substr(county_fips, 1, 2) NOT IN ('00', '03')")
def _(w: Workspace) -> DataFrame:
    return w.declarations().filter(~F.substring("county_fips", 1, 2).isin(*fips.BAD_STATES)).select("id", "county_fips")


@query("flt5_exists_row", "SELECT 1 AS fail WHERE EXISTS (SELECT 1 FROM summary_lenient WHERE year < 1996 OR year > 2000)")
def _(w: Workspace) -> DataFrame:
    outside = ~F.col("year").between(WINDOW.first, WINDOW.last)
    return w.summary_lenient().filter(outside).limit(1).select(F.lit(1).alias("fail"))


@query(
    "flt6_directory_search",
    "SELECT county_fips, county_name, state FROM centroids WHERE contains(lower(county_name), 'lake f') AND state = 'State 4'",
)
def _(w: Workspace) -> DataFrame:
    return serving.search_directory(w.centroids(), "LAKE F", "State 4")


# --- joins ----------------------------------------------------------------------------


@query("jn01_left_semi", "SELECT zip5, county_fips, year FROM crosswalk x WHERE EXISTS (SELECT 1 FROM scores s WHERE s.county_fips = trim(x.county_fips))")
def _(w: Workspace) -> DataFrame:
    return keys.keep_canonical(w.crosswalk(), w.scores()).select("zip5", "county_fips", "year")


@query("jn02_left_anti", "SELECT zip5, county_fips, year FROM crosswalk x WHERE NOT EXISTS (SELECT 1 FROM scores s WHERE s.county_fips = trim(x.county_fips))")
def _(w: Workspace) -> DataFrame:
    return keys.not_canonical(w.crosswalk(), w.scores()).select("zip5", "county_fips", "year")


@query(
    "jn03_anti_is_null",
    "SELECT DISTINCT e.event_type FROM events_clean e LEFT JOIN type_map m ON e.event_type = m.event_type WHERE m.event_type IS NULL",
)
def _(w: Workspace) -> DataFrame:
    return checks.unmapped(w.events(), w.type_map(), "event_type", "event_type")


@query(
    "jn04_unique_groups_join_back",
    "SELECT c.county_fips, c.state_fips_norm, c.county_name_norm FROM counties c JOIN (SELECT state_fips_norm, county_name_norm FROM counties GROUP BY ALL HAVING count(*) = 1) g "
    "USING (state_fips_norm, county_name_norm)",
)
def _(w: Workspace) -> DataFrame:
    return _lookup(w, "county_name_norm").select("county_fips", "state_fips_norm", "county_name_norm")


@query(
    "jn05_conditional_left_join",
    "SELECT county_fips_mapping_method, count(*) AS n, count(DISTINCT county_fips) AS counties FROM classified GROUP BY 1",
)
def _(w: Workspace) -> DataFrame:
    rows = silver.clean_events(w.raw("events"), w.counties())
    return rows.groupBy(resolve.METHOD).agg(
        F.count("*").alias("n"), F.count_distinct("county_fips").alias("counties")
    )


@query("jn06_census_star", f"SELECT county_fips, county_name, {', '.join(schemas.CENSUS_MEASURES)}, acs_year FROM census")
def _(w: Workspace) -> DataFrame:
    return silver.clean_census(w.acs())


@query(
    "jn07_claims_declarations_crosswalk",
    f"SELECT c.disasternumber, d.year, c.zip5, x.county_fips, count(*) AS claims FROM (SELECT *, {zip5('zipcode')} AS zip5 FROM claims) c "
    "JOIN decl_years d ON c.disasternumber = d.disasternumber AND trim(c.state) = d.state JOIN crosswalk x ON c.zip5 = x.zip5 AND d.year = x.year GROUP BY ALL",
)
def _(w: Workspace) -> DataFrame:
    return allocate.claims_by_county_of_zip(w.claims(), w.declarations(), w.crosswalk(), WINDOW)


@query("jn08_scaffold_joins", f"SELECT county_fips, year, noaa_event_count, fema_declaration_count, population_total, nri_risk_score FROM mart")
def _(w: Workspace) -> DataFrame:
    return w.build_mart().select(
        "county_fips", "year", "noaa_event_count", "fema_declaration_count", "population_total", "nri_risk_score"
    )


@query("jn09_counties_by_years", "SELECT county_fips, year FROM dim, years")
def _(w: Workspace) -> DataFrame:
    return rollups.county_year_universe(w.dim(), w.years())


@query(
    "jn10_one_row_aggregates",
    "SELECT (SELECT count(*) FROM dim) AS counties, (SELECT count(*) FROM years) AS years, (SELECT count(*) FROM universe) AS universe_rows",
)
def _(w: Workspace) -> DataFrame:
    return w.dim().agg(F.count("*").alias("counties")).select(
        "counties",
        w.years().agg(F.count("*")).scalar().alias("years"),
        w.universe().agg(F.count("*")).scalar().alias("universe_rows"),
    )


@query(
    "jn11_disaster_map_shares",
    "SELECT m.disasternumber, m.year, count(*) AS counties, any_value(c.totaldamage) AS totaldamage FROM county_map m JOIN claims_by_disaster c USING (disasternumber) "
    "JOIN county_counts k ON m.disasternumber = k.disasternumber AND m.year = k.year GROUP BY 1, 2",
)
def _(w: Workspace) -> DataFrame:
    county_map = allocate.disaster_county_map(w.declarations())
    return (
        allocate.disaster_county_counts(county_map)
        .join(allocate.claims_by_disaster(w.claims()), "disasternumber")
        .select("disasternumber", "year", F.col("county_cnt").alias("counties"), "totaldamage")
    )


@query(
    "jn12_hazard_group_decode",
    "SELECT s.county_fips, s.year, s.hazard_type, s.hazard_category, m.hazard_group FROM summary s LEFT JOIN type_map m ON s.hazard_type = m.event_type",
)
def _(w: Workspace) -> DataFrame:
    decode = w.type_map().select(F.col("event_type").alias("hazard_type"), "hazard_group")
    return w.summary().join(decode, "hazard_type", "left").select(
        "county_fips", "year", "hazard_type", "hazard_category", "hazard_group"
    )


@query(
    "jn13_centroids_left_join",
    "SELECT m.county_fips, m.year, c.lat, c.lon, c.county_name, c.state FROM mart m LEFT JOIN centroids c ON lpad(m.county_fips, 5, '0') = lpad(c.county_fips, 5, '0')",
)
def _(w: Workspace) -> DataFrame:
    return keys.add_centroids(w.mart().select("county_fips", "year"), w.centroids())


@query("jn14_name_lookup", "SELECT s.county_fips, s.state, c.county_name FROM scores s LEFT JOIN census_name c USING (county_fips)")
def _(w: Workspace) -> DataFrame:
    return w.scores().select("county_fips", "state").join(gold.census_latest_name(w.census()), "county_fips", "left")


@query(
    "jn15_scalar_subqueries",
    "SELECT (SELECT count(*) FROM mart WHERE year = 1998) AS risk_rows_year, (SELECT count(*) FROM centroids) AS centroid_rows, "
    "(SELECT count(*) FROM summary WHERE year = 1998) AS noaa_rows_year",
)
def _(w: Workspace) -> DataFrame:
    return serving.health_counts(w.mart(), w.centroids(), w.summary(), 1998).drop("selected_year")
