"""The pipeline as DuckDB common table expressions, written apart from the Spark code."""

from __future__ import annotations

import re

from .. import schemas
from ..functions.geonames import ALASKA_NAMES
from . import adapters

LO, HI = adapters.FIRST_YEAR, adapters.LAST_YEAR


def std(c: str) -> str:
    return f"lpad(regexp_replace(cast({c} AS VARCHAR), '[^0-9]', '', 'g'), 5, '0')"


def sane(c: str) -> str:
    return (
        f"({c} IS NOT NULL AND length(trim({c})) = 5 AND substr(trim({c}), 1, 2) NOT IN ('00', '03') "
        f"AND substr(trim({c}), 3, 3) <> '000')"
    )


def codes(s: str, c: str) -> str:
    return f"(lpad(cast({s} AS VARCHAR), 2, '0') || lpad(cast({c} AS VARCHAR), 3, '0'))"


def nname(c: str) -> str:
    x = f"replace(regexp_replace(upper(trim({c})), ',.*$', ''), '&', ' AND ')"
    x = rf"regexp_replace({x}, '\([A-Z]\)', ' ', 'g')"
    # Words for kinds of areas.
    x = (
        rf"regexp_replace({x}, '\b(COUNTY|PARISH|CITY AND BOROUGH|BOROUGH|CENSUS AREA|MUNICIPALITY|MUNICIPIO)\b', '', 'g')"
    )
    x = rf"regexp_replace({x}, '\bCITY\b', ' ', 'g')"
    x = f"trim(regexp_replace({x}, '[^A-Z0-9]+', ' ', 'g'))"
    return f"(CASE WHEN trim({c}) <> '' THEN {x} END)"


def compact(c: str) -> str:
    return rf"(CASE WHEN trim({c}) <> '' THEN regexp_replace(trim({c}), '\s+', '', 'g') END)"


def blank(c: str) -> str:
    return f"(CASE WHEN trim({c}) <> '' THEN {c} END)"


def report_time(t: str, year: str) -> str:
    t = f"upper(trim({t}))"
    same = f"(({year} // 100) * 100 + try_cast(substr({t}, 8, 2) AS INT))"
    full = f"(CASE WHEN {same} < {year} - 50 THEN {same} + 100 WHEN {same} > {year} + 50 THEN {same} - 100 ELSE {same} END)"
    form = rf"regexp_matches({t}, '^\d\d-[A-Z]{{3}}-\d\d \d\d:\d\d:\d\d$')"
    return (
        f"(CASE WHEN {form} THEN try_strptime(substr({t}, 1, 7) || cast({full} AS VARCHAR) || substr({t}, 10), '%d-%b-%Y %H:%M:%S') "
        f"ELSE try_cast({t} AS TIMESTAMP) END)"
    )


def strict(c: str) -> str:
    t = f"upper(trim({c}))"
    parts = " ".join(
        f"WHEN regexp_matches({t}, '^[0-9]+(\\.[0-9]+)?{s}$') THEN try_cast(regexp_extract({t}, '^([0-9]+(\\.[0-9]+)?){s}$', 1) AS DOUBLE) * {f}"
        for s, f in (("", "1.0"), ("K", "1000.0"), ("M", "1000000.0"), ("B", "1000000000.0"))
    )
    return f"(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 0.0 {parts} ELSE 0.0 END)"


def lenient(c: str) -> str:
    t = f"trim(regexp_replace({c}, '[$,]', '', 'g'))"
    head = f"try_cast(substr({t}, 1, length({t}) - 1) AS DOUBLE)"
    return (
        f"(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN NULL ELSE CASE upper(right({t}, 1)) "
        f"WHEN 'K' THEN {head} * 1000 WHEN 'M' THEN {head} * 1000000 WHEN 'B' THEN {head} * 1000000000 "
        f"ELSE try_cast({t} AS DOUBLE) END END)"
    )


def zsum(*cols: str) -> str:
    return "cast(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + " AS BIGINT)"


def zip5(c: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({c}, '[0-9]{{5}}') THEN regexp_extract({c}, '[0-9]{{5}}') "
        f"WHEN regexp_matches({c}, '[0-9]') THEN lpad(regexp_extract({c}, '[0-9]+'), 5, '0') END)"
    )


def first_by(source: str, keys: list[str], columns: list[str], latest: str | None = "run_dt") -> str:
    """First row per key: newest first, then the smallest by the other columns."""
    order = [f"{latest} DESC NULLS LAST"] if latest and latest in columns else []
    order += [f"{c} ASC NULLS FIRST" for c in columns if c not in keys and c != latest]
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) = 1"
    )


_M = list(schemas.CLAIM_MEASURES)
_EV = adapters.columns("events")
_DE = adapters.columns("declarations")
_CL = [*schemas.CLAIMS, "run_dt"]
_NR = adapters.columns("nri")
_DATES = ("declarationdate", "incidentbegindate", "incidentenddate")


def _claims_side(name: str, tenure: str) -> str:
    have = set(adapters.columns(name))
    cols = []
    for c, t in schemas.CLAIMS.items():
        if c == "tenure":
            cols.append(f"'{tenure}' AS tenure")
        elif c not in have:
            cols.append(f"cast(NULL AS {t}) AS {c}")
        else:
            cols.append(c if t == "string" else f"try_cast({c} AS {t}) AS {c}")
    return f"SELECT {', '.join(cols)}, run_dt FROM raw_{name}"


def _census_side(table: str, cells: dict[str, str]) -> str:
    extra = ["county_name"] if table == "b01001" else []
    head = "name AS county_name, " if extra else ""
    shaped = (
        f"(SELECT {codes('state', 'county')} AS county_fips, {head}"
        + ", ".join(f"try_cast({cell} AS BIGINT) AS {out}" for cell, out in cells.items())
        + f" FROM raw_{table})"
    )
    return first_by(shaped, ["county_fips"], ["county_fips", *extra, *cells.values()], None)


_CELLS = {
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
_CENSUS = list(schemas.CENSUS_MEASURES)

CTES: dict[str, str] = {f"raw_{n}": adapters.raw_sql(n) for n in adapters.RAW}

CTES["keyed_events"] = (
    "SELECT * FROM (SELECT * REPLACE ("
    + ", ".join(f"{blank(c)} AS {c}" for c in ("state", "state_fips", "cz_fips", "event_type"))
    + r", try_cast(regexp_extract(year, '(\d{4})', 1) AS INT) AS year) FROM raw_events) "
    + "WHERE "
    + " AND ".join(
        f"{c} IS NOT NULL" for c in ("event_id", "episode_id", "state", "state_fips", "cz_fips", "event_type", "year")
    )
)
CTES["uniq_raw"] = first_by("keyed_events", ["event_id", "episode_id"], _EV)
CTES["uniq_events"] = (
    "SELECT * REPLACE ("
    + ", ".join(
        [f"{report_time(c, 'year')} AS {c}" for c in ("begin_date_time", "end_date_time")]
        + [
            f"try_cast({c} AS INT) AS {c}"
            for c in ("begin_day", "injuries_direct", "injuries_indirect", "deaths_direct", "deaths_indirect")
        ]
        + [f"try_cast({c} AS DOUBLE) AS {c}" for c in ("magnitude", "begin_lat")]
    )
    + ") FROM uniq_raw"
)
CTES["counties"] = first_by(
    f"(SELECT * FROM (SELECT {std(blank('stcofips'))} AS county_fips, "
    f"CASE WHEN trim(statefips) <> '' THEN lpad(statefips, 2, '0') END AS state_fips_norm, {nname('county')} AS county_name_norm, "
    f"{compact(nname('county'))} AS county_name_compact FROM raw_nri) WHERE {sane('county_fips')})",
    ["county_fips"],
    ["county_fips", "state_fips_norm", "county_name_norm", "county_name_compact"],
    None,
)
CTES["name_lookup"] = (
    "SELECT state_fips_norm, county_name_norm, min(county_fips) AS county_fips FROM counties "
    "WHERE state_fips_norm IS NOT NULL AND county_name_norm IS NOT NULL GROUP BY ALL HAVING count(*) = 1"
)
CTES["compact_lookup"] = (
    "SELECT state_fips_norm, county_name_compact, min(county_fips) AS county_fips FROM counties "
    "WHERE state_fips_norm IS NOT NULL AND county_name_compact IS NOT NULL GROUP BY ALL HAVING count(*) = 1"
)
CTES["candidates"] = (
    "SELECT *, county_fips AS county_fips_raw_candidate FROM (SELECT *, "
    f"CASE WHEN state_fips_norm = '72' THEN '72' || lpad(cz_fips, 3, '0') WHEN cz_type_norm = 'C' THEN {codes('state_fips', 'cz_fips')} END AS county_fips, "
    f"{compact('cz_name_norm')} AS cz_name_compact FROM (SELECT *, CASE WHEN trim(cz_type) <> '' THEN upper(trim(cz_type)) END AS cz_type_norm, "
    f"CASE WHEN lpad(state_fips, 2, '0') = '99' THEN '72' ELSE lpad(state_fips, 2, '0') END AS state_fips_norm, "
    f"{nname('cz_name')} AS cz_name_norm FROM uniq_events))"
)
CTES["classified"] = (
    "SELECT e.* REPLACE (CASE WHEN coalesce(e.cz_type_norm = 'C', false) THEN coalesce(d.county_fips, n.county_fips, k.county_fips) ELSE e.county_fips END AS county_fips), "
    "CASE WHEN NOT coalesce(e.cz_type_norm = 'C', false) THEN 'non_county_zone' WHEN d.county_fips IS NOT NULL THEN 'direct_code' "
    "WHEN n.county_fips IS NOT NULL THEN 'name_match' WHEN k.county_fips IS NOT NULL THEN 'name_match_compact' ELSE 'unresolved' END AS county_fips_mapping_method "
    "FROM candidates e LEFT JOIN counties d ON trim(e.county_fips) = d.county_fips "
    "LEFT JOIN name_lookup n ON e.state_fips_norm = n.state_fips_norm AND e.cz_name_norm = n.county_name_norm "
    "LEFT JOIN compact_lookup k ON e.state_fips_norm = k.state_fips_norm AND e.cz_name_compact = k.county_name_compact"
)
CTES["events_clean"] = (
    "SELECT * FROM classified WHERE county_fips_mapping_method NOT IN ('unresolved', 'non_county_zone')"
)
CTES["declarations"] = first_by(
    "(SELECT * REPLACE ("
    + ", ".join(
        f"try_cast({c} AS BIGINT) AS {c}"
        for c in ("disasternumber", "fydeclared", "ihprogramdeclared", "fipsstatecode", "fipscountycode")
    )
    + ", "
    + ", ".join(f"try_cast(substr({c}, 1, 10) AS DATE) AS {c}" for c in _DATES)
    + f"), {codes('try_cast(fipsstatecode AS BIGINT)', 'try_cast(fipscountycode AS BIGINT)')} AS county_fips FROM raw_declarations)",
    ["id"],
    [*_DE, "county_fips"],
)
CTES["claims_union"] = _claims_side("owners", "owner") + " UNION ALL " + _claims_side("renters", "renter")
CTES["claims"] = f"SELECT {', '.join(schemas.CLAIMS)} FROM ({first_by('claims_union', ['id', 'tenure'], _CL)})"
CTES["scores_keyed"] = first_by(
    f"(SELECT *, {std(blank('stcofips'))} AS county_fips FROM raw_nri)", ["county_fips"], [*_NR, "county_fips"], None
)
CTES["scores"] = f"SELECT * FROM scores_keyed WHERE {sane('county_fips')}"
CTES["scores_unresolved"] = f"SELECT * FROM scores_keyed WHERE NOT coalesce({sane('county_fips')}, false)"
for _t, _c in _CELLS.items():
    CTES[f"census_{_t}"] = _census_side(_t, _c)
CTES["census"] = (
    "SELECT b.county_fips, b.county_name, b.population_total, i.median_household_income, h.median_home_value, "
    "e.employment_universe_total, e.in_labor_force, e.unemployed, d.education_universe_total, d.high_school_grad, d.bachelors, d.graduate_degree, "
    "2022 AS acs_year FROM census_b01001 b LEFT JOIN census_b19013 i USING (county_fips) LEFT JOIN census_b25077 h USING (county_fips) "
    "LEFT JOIN census_b23025 e USING (county_fips) LEFT JOIN census_b15003 d USING (county_fips)"
)
CTES["census_years"] = (
    f"SELECT {codes('state', 'county')} AS county_fips, name AS county_name, try_cast(acs_year AS INT) AS acs_year, "
    "try_cast(b01001_001e AS BIGINT) AS population_total FROM raw_b01001"
)
CTES["crosswalk"] = (
    "SELECT * FROM (SELECT lpad(zip, 5, '0') AS zip5, lpad(county, 5, '0') AS county_fips, try_cast(tot_ratio AS DOUBLE) AS tot_ratio, "
    f"try_cast(year AS INT) AS year FROM raw_crosswalk WHERE lower(trim(top_match)) IN ('true', 't', '1')) WHERE {sane('county_fips')}"
)
CTES["type_map"] = "SELECT * FROM raw_type_map"
CTES["centroids"] = first_by(
    f"(SELECT * FROM (SELECT {std('county_fips')} AS county_fips, county_name, state, try_cast(lat AS DOUBLE) AS lat, try_cast(lon AS DOUBLE) AS lon "
    f"FROM raw_centroids) WHERE {sane('county_fips')})",
    ["county_fips"],
    ["county_fips", "county_name", "state", "lat", "lon"],
    None,
)
CTES["summary"] = (
    "SELECT county_fips, event_type AS hazard_type, coalesce(category, 'UNKNOWN') AS hazard_category, count(*) AS event_count, "
    f"cast(sum({zsum('deaths_direct', 'deaths_indirect')}) AS BIGINT) AS total_fatalities, "
    f"cast(sum({zsum('injuries_direct', 'injuries_indirect')}) AS BIGINT) AS total_injuries, "
    f"avg({strict('damage_property')}) AS avg_property_damage, year FROM events_clean "
    f"WHERE {sane('county_fips')} AND year BETWEEN {LO} AND {HI} GROUP BY county_fips, event_type, coalesce(category, 'UNKNOWN'), year"
)
CTES["summary_lenient"] = (
    "SELECT county_fips, event_type AS hazard_type, coalesce(category, 'UNKNOWN') AS hazard_category, count(*) AS event_count, "
    f"cast(sum({zsum('deaths_direct', 'deaths_indirect')}) AS BIGINT) AS total_fatalities, "
    f"cast(sum({zsum('injuries_direct', 'injuries_indirect')}) AS BIGINT) AS total_injuries, "
    f"avg({lenient('damage_property')}) AS avg_property_damage, cast(year(begin_date_time) AS INT) AS year FROM events_clean "
    "WHERE begin_date_time IS NOT NULL GROUP BY county_fips, event_type, coalesce(category, 'UNKNOWN'), cast(year(begin_date_time) AS INT)"
)
CTES["noaa_county_year"] = (
    "SELECT county_fips, year, count(*) AS noaa_event_count, "
    f"cast(sum({zsum('deaths_direct', 'deaths_indirect')}) AS BIGINT) AS noaa_total_fatalities, "
    f"cast(sum({zsum('injuries_direct', 'injuries_indirect')}) AS BIGINT) AS noaa_total_injuries, "
    f"avg({strict('damage_property')}) AS noaa_avg_property_damage FROM events_clean WHERE {sane('county_fips')} AND year BETWEEN {LO} AND {HI} GROUP BY county_fips, year"
)
CTES["decl_years"] = (
    "SELECT DISTINCT disasternumber, trim(state) AS state, try_cast(fydeclared AS INT) AS year FROM declarations "
    f"WHERE disasternumber IS NOT NULL AND trim(state) <> '' AND fydeclared BETWEEN {LO} AND {HI}"
)
CTES["fema_county_year"] = (
    "SELECT x.county_fips, d.year, "
    + ", ".join(f"sum(coalesce(c.{m}, 0) * coalesce(x.tot_ratio, 1.0)) AS {o}" for m, o in schemas.CLAIM_MEASURES.items())
    + ", count(DISTINCT d.disasternumber) AS fema_declaration_count "
    f"FROM (SELECT *, {zip5('zipcode')} AS zip5 FROM claims WHERE disasternumber IS NOT NULL AND trim(state) <> '') c "
    "JOIN decl_years d ON c.disasternumber = d.disasternumber AND trim(c.state) = d.state "
    "JOIN crosswalk x ON c.zip5 = x.zip5 AND d.year = x.year GROUP BY x.county_fips, d.year"
)
CTES["census_latest"] = (
    f"SELECT * FROM census WHERE {sane('county_fips')} AND acs_year IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY county_fips ORDER BY acs_year DESC) = 1"
)
CTES["nri_county"] = (
    f"SELECT {std('county_fips')} AS county_fips, "
    + ", ".join(f"try_cast({c} AS DOUBLE) AS {o}" for c, o in schemas.NRI_SCORES.items())
    + " FROM scores"
)
_FEATURES = (
    ", ".join(f"coalesce(n.{c}, 0) AS {c}" for c in schemas.EVENT_FEATURES)
    + ", "
    + ", ".join(f"coalesce(f.{c}, 0) AS {c}" for c in schemas.CLAIM_FEATURES if c != "fema_declaration_count")
)
_STATIC = (
    ", ".join(f"c.{m}" for m in _CENSUS)
    + ", c.acs_year AS census_acs_year, "
    + ", ".join(f"r.{o}" for o in schemas.NRI_SCORES.values())
)
CTES["mart"] = (
    f"SELECT u.county_fips, {_FEATURES}, coalesce(f.fema_declaration_count, 0) AS fema_declaration_count, {_STATIC}, u.year FROM "
    "(SELECT county_fips, year FROM noaa_county_year UNION SELECT county_fips, year FROM fema_county_year) u "
    "LEFT JOIN noaa_county_year n ON u.county_fips = n.county_fips AND u.year = n.year "
    "LEFT JOIN fema_county_year f ON u.county_fips = f.county_fips AND u.year = f.year "
    "LEFT JOIN census_latest c ON u.county_fips = c.county_fips LEFT JOIN nri_county r ON u.county_fips = r.county_fips"
)
CTES["census_name"] = (
    "SELECT county_fips, county_name FROM census WHERE county_fips IS NOT NULL AND county_name IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY county_fips ORDER BY acs_year DESC, county_name) = 1"
)
_OVERRIDE = "CASE county_fips " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ALASKA_NAMES.items()) + " END"
CTES["dim_names"] = (
    r"SELECT county_fips, state, state_fips_str, coalesce(" + _OVERRIDE + r", nullif(nri_name, ''), nullif(census_name, '')) AS name FROM ("
    r"SELECT n.*, CASE WHEN regexp_matches(c.county_name, concat(',\s*', n.state, '$')) THEN trim(regexp_replace(c.county_name, concat(',\s*', n.state, '$'), '')) END AS census_name "
    r"FROM (SELECT county_fips, max(state) AS state, max(statefips) AS state_fips_str, trim(regexp_replace(regexp_replace(trim(regexp_replace(max(county), ',\s*[^,]+$', '')), ',\s*Connecticut$', ''), ',\s*Conneccticut$', '')) AS nri_name FROM scores GROUP BY county_fips) n "
    r"LEFT JOIN census_name c ON n.county_fips = c.county_fips)"
)
CTES["dim"] = (
    "SELECT county_fips, shown AS county_name, state, CASE WHEN trim(state_fips_str) <> '' THEN lpad(regexp_replace(state_fips_str, '[^0-9]', '', 'g'), 2, '0') END AS state_fips, "
    "lower(trim(shown)) AS county_name_normalized FROM (SELECT *, CASE WHEN state = 'Connecticut' THEN trim(regexp_replace(name, ' +Connecticut$', '')) ELSE name END AS shown FROM dim_names)"
)
CTES["years"] = (
    "SELECT DISTINCT year FROM (SELECT cast(year(begin_date_time) AS INT) AS year FROM events_clean UNION SELECT try_cast(fydeclared AS INT) FROM declarations) WHERE year IS NOT NULL"
)
CTES["universe"] = "SELECT county_fips, year FROM dim, years"
CTES["noaa_rollup"] = (
    "SELECT county_fips, year, cast(sum(event_count) AS BIGINT) AS noaa_event_count, cast(sum(total_fatalities) AS BIGINT) AS noaa_total_fatalities, "
    "cast(sum(total_injuries) AS BIGINT) AS noaa_total_injuries, avg(avg_property_damage) AS noaa_avg_property_damage FROM summary_lenient GROUP BY county_fips, year"
)
CTES["decls_county_year"] = (
    "SELECT county_fips, try_cast(fydeclared AS INT) AS year, count(*) AS fema_declaration_count FROM declarations "
    "WHERE county_fips IS NOT NULL AND try_cast(fydeclared AS INT) IS NOT NULL GROUP BY 1, 2"
)
CTES["claims_by_disaster"] = (
    "SELECT disasternumber, "
    + ", ".join(f"sum(coalesce(cast({m} AS DOUBLE), 0)) AS {m}" for m in _M)
    + " FROM claims WHERE disasternumber IS NOT NULL GROUP BY 1"
)
CTES["county_map"] = (
    "SELECT DISTINCT disasternumber, county_fips, try_cast(fydeclared AS INT) AS year FROM declarations "
    "WHERE disasternumber IS NOT NULL AND county_fips IS NOT NULL AND try_cast(fydeclared AS INT) IS NOT NULL"
)
CTES["county_counts"] = (
    "SELECT disasternumber, year, count(DISTINCT county_fips) AS county_cnt FROM county_map GROUP BY 1, 2"
)
CTES["equal_shares"] = (
    "SELECT m.county_fips, m.year, "
    + ", ".join(f"sum(c.{k} / nullif(cc.county_cnt, 0)) AS {o}" for k, o in schemas.CLAIM_MEASURES.items())
    + " FROM county_map m JOIN claims_by_disaster c ON m.disasternumber = c.disasternumber "
    "JOIN county_counts cc ON m.disasternumber = cc.disasternumber AND m.year = cc.year GROUP BY 1, 2"
)
CTES["scaffold"] = (
    f"SELECT u.county_fips, {_FEATURES}, coalesce(d.fema_declaration_count, 0) AS fema_declaration_count, {_STATIC}, u.year FROM universe u "
    "LEFT JOIN noaa_rollup n ON u.county_fips = n.county_fips AND u.year = n.year "
    "LEFT JOIN equal_shares f ON u.county_fips = f.county_fips AND u.year = f.year "
    "LEFT JOIN decls_county_year d ON u.county_fips = d.county_fips AND u.year = d.year "
    "LEFT JOIN census c ON u.county_fips = c.county_fips LEFT JOIN nri_county r ON u.county_fips = r.county_fips"
)

_WORD = re.compile(r"[a-z_0-9]+")


def with_ctes(body: str) -> str:
    """The statement with the common tables it needs, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(_WORD.findall(text)) & CTES.keys():
            if word not in needed:
                needed.add(word)
                visit(CTES[word])

    visit(body)
    if not needed:
        return body
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed) + " " + body
