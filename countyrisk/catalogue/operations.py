"""Queries: quality checks, gate, audits, landing, serving."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import casts, names
from ..operators import allocate, checks, ranking
from ..operators.checks import WARNING, Check, Suite
from ..plans import audits, contracts, gold, publish, quality, serving
from ..session import scratch_dir
from ..sources import landing
from .columns import _LISTING, _csv, _event_csv, _listing
from .oracle import sane
from .registry import query
from .workspace import WINDOW, Workspace

YEAR = 1998
COUNTY = "04004"


def _row(df: DataFrame, column) -> DataFrame:
    return df.agg(column.alias("failures"))


def _failing(source: str, condition: str) -> str:
    return f"SELECT count(*) AS failures FROM {source} WHERE {condition}"


# --- checks ------------------------------------------------------------------------------


@query("qa01_rowcount_nonzero", "SELECT cast(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failures FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return quality.rowcount_nonzero(w.raw("events"))


@query(
    "qa02_required_columns",
    "SELECT count(*) AS failures FROM (VALUES ('event_id'), ('episode_id'), ('state'), ('state_fips'), ('cz_fips'), ('event_type'), ('begin_date_time'), "
    "('end_date_time'), ('year')) AS t(c) WHERE c NOT IN (SELECT lower(column_name) FROM (DESCRIBE SELECT event_id, episode_id, state FROM raw_events))",
)
def _(w: Workspace) -> DataFrame:
    path = w.written("csv_three_columns", lambda p: _csv(w.raw("events").select("EVENT_ID", "EPISODE_ID", "STATE"), p))
    missing = checks.missing_headers(w.spark, path, schemas.EVENT_REQUIRED)
    return missing.select(F.explode("missing").alias("name")).agg(F.count_distinct("name").alias("failures"))


@query(
    "qa03_grain_keys_not_null",
    _failing("raw_events", " OR ".join(f"{c} IS NULL" for c in quality.GRAIN_KEYS)),
)
def _(w: Workspace) -> DataFrame:
    return _row(names.normalize_columns(w.raw("events")), checks.any_null(quality.GRAIN_KEYS))


@query(
    "qa03_excluded_files",
    _failing("(SELECT year FROM events_clean WHERE year <> 1999)", "year < 1998"),
)
def _(w: Workspace) -> DataFrame:
    return _row(quality.exclude_files(w.events(), "/year=1999/"), checks.count_if(F.col("year") < 1998))


@query(
    "qa04_year_complete",
    r"SELECT cast(CASE WHEN count(*) = 0 OR count(*) > count(year) THEN 1 ELSE 0 END AS BIGINT) AS failures FROM (SELECT try_cast(regexp_extract(year, '(\d{4})', 1) AS INT) AS year FROM raw_events)",
)
def _(w: Workspace) -> DataFrame:
    return _row(casts.with_year(names.normalize_columns(w.raw("events"))), checks.year_complete())


_CANONICAL = f"(SELECT DISTINCT trim(county_fips) FROM census WHERE {sane('county_fips')})"


@query(
    "qa05_summary_keys_canonical",
    f"SELECT count(DISTINCT county_fips) AS failures FROM summary WHERE county_fips NOT IN (SELECT county_fips FROM centroids WHERE lat > 30)",
)
def _(w: Workspace) -> DataFrame:
    return checks.referential(w.summary(), w.centroids().filter("lat > 30"))


def _groups(source: str, grain: str) -> str:
    return f"SELECT count(*) AS failures FROM (SELECT 1 FROM {source} GROUP BY {grain} HAVING count(*) > 1)"


@query("qa05_summary_keys_in_census", f"SELECT count(DISTINCT county_fips) AS failures FROM summary WHERE county_fips NOT IN {_CANONICAL}")
def _(w: Workspace) -> DataFrame:
    return checks.referential(w.summary(), w.census())


@query("qa06_summary_grain_three_columns", _groups("summary", "county_fips, year, hazard_type"))
def _(w: Workspace) -> DataFrame:
    return checks.unique(w.summary(), ("county_fips", "year", "hazard_type"))


@query("qa07_summary_nonnegative", _failing("summary", "event_count < 0 OR total_fatalities < 0 OR total_injuries < 0 OR avg_property_damage < 0"))
def _(w: Workspace) -> DataFrame:
    return _row(w.summary(), checks.any_negative(quality.SUMMARY_METRICS))


@query("qa08_mart_keys_canonical", f"SELECT count(DISTINCT county_fips) AS failures FROM mart WHERE county_fips NOT IN {_CANONICAL}")
def _(w: Workspace) -> DataFrame:
    return checks.referential(w.mart(), w.census())


@query(
    "qa09_mart_covers_universe",
    "SELECT count(*) AS failures FROM universe u LEFT JOIN mart m ON u.county_fips = m.county_fips AND u.year = m.year WHERE m.county_fips IS NULL",
)
def _(w: Workspace) -> DataFrame:
    return checks.covers(w.mart(), w.universe(), ("county_fips", "year"))


@query("qa10_mart_grain", _groups("mart", "county_fips, year"))
def _(w: Workspace) -> DataFrame:
    return checks.unique(w.mart(), ("county_fips", "year"))


@query(
    "qa11_year_window",
    "SELECT cast(CASE WHEN EXISTS (SELECT 1 FROM summary_lenient WHERE year NOT BETWEEN 1996 AND 2000) THEN 1 ELSE 0 END AS BIGINT) AS failures",
)
def _(w: Workspace) -> DataFrame:
    return _row(w.summary_lenient(), checks.outside_window(WINDOW.first, WINDOW.last))


@query("qa11_mart_year_window", "SELECT cast(CASE WHEN EXISTS (SELECT 1 FROM mart WHERE year NOT BETWEEN 1996 AND 2000) THEN 1 ELSE 0 END AS BIGINT) AS failures")
def _(w: Workspace) -> DataFrame:
    return _row(w.mart(), checks.outside_window(WINDOW.first, WINDOW.last))


@query("qa12_unmapped_hazards", "SELECT DISTINCT event_type FROM events_clean WHERE event_type NOT IN (SELECT event_type FROM type_map)")
def _(w: Workspace) -> DataFrame:
    return checks.unmapped(w.events(), w.type_map(), "event_type", "event_type")


@query("qa13_county_dim_unique", "SELECT county_name, count(*) AS cnt FROM dim WHERE county_name IS NOT NULL GROUP BY county_name HAVING count(*) > 1")
def _(w: Workspace) -> DataFrame:
    return checks.duplicate_groups(w.dim().filter("county_name IS NOT NULL"), ["county_name"])


@query("qa13_county_dim_keys_unique", "SELECT county_fips, count(*) AS cnt FROM (SELECT county_fips FROM dim UNION ALL SELECT county_fips FROM dim WHERE state = 'Connecticut') GROUP BY county_fips HAVING count(*) > 1")
def _(w: Workspace) -> DataFrame:
    # the keys of one state a second time, so that there is something to find
    seeded = w.dim().unionByName(w.dim().filter("state = 'Connecticut'"))
    return checks.duplicate_groups(seeded.select("county_fips"), ["county_fips"])


@query(
    "qa14_universe_rowcount_of_the_universe",
    "SELECT c.n AS counties, y.n AS years, c.n * y.n AS expected_universe_rows, u.n AS universe_rows FROM (SELECT count(*) AS n FROM dim) c, "
    "(SELECT count(*) AS n FROM years) y, (SELECT count(*) AS n FROM universe WHERE year <> 1998) u WHERE c.n * y.n <> u.n",
)
def _(w: Workspace) -> DataFrame:
    # the whole universe agrees (tests); without a year it must not
    return quality.universe_mismatch(w.dim(), w.years(), w.universe().filter("year <> 1998"))


@query(
    "qa14_universe_rowcount",
    "SELECT c.n AS counties, y.n AS years, c.n * y.n AS expected_universe_rows, u.n AS universe_rows FROM (SELECT count(*) AS n FROM dim) c, "
    "(SELECT count(*) AS n FROM years) y, (SELECT count(*) AS n FROM mart) u WHERE c.n * y.n <> u.n",
)
def _(w: Workspace) -> DataFrame:
    return quality.universe_mismatch(w.dim(), w.years(), w.mart())


@query("qa15_universe_unique", "SELECT county_fips, year, count(*) AS cnt FROM universe GROUP BY 1, 2 HAVING count(*) > 1")
def _(w: Workspace) -> DataFrame:
    return checks.duplicate_groups(w.universe(), ("county_fips", "year"))


@query("qa16_summary_unique_with_category", "SELECT county_fips, year, hazard_type, hazard_category, count(*) AS cnt FROM summary GROUP BY 1, 2, 3, 4 HAVING count(*) > 1")
def _(w: Workspace) -> DataFrame:
    return checks.duplicate_groups(w.summary(), ("county_fips", "year", "hazard_type", "hazard_category"))


@query("qa17_summary_negative_sample", f"SELECT {', '.join(schemas.SUMMARY_COLUMNS)} FROM summary WHERE event_count < 0 OR total_fatalities < 0 OR total_injuries < 0 OR avg_property_damage < 0 LIMIT 50")
def _(w: Workspace) -> DataFrame:
    return checks.violations(w.summary(), quality.SUMMARY_METRICS)


# Seeded violations: a good table has nothing to find, so some rows are doubled or spoilt first.

_SUMMARY_NEGATIVE = "county_fips, hazard_type, hazard_category, -1 - event_count AS event_count, total_fatalities, total_injuries, avg_property_damage, year"


@query("qa15_universe_unique_seeded", "SELECT county_fips, year, count(*) AS cnt FROM (SELECT county_fips, year FROM universe UNION ALL SELECT county_fips, year FROM universe WHERE year = 1997) GROUP BY 1, 2 HAVING count(*) > 1")
def _(w: Workspace) -> DataFrame:
    return checks.duplicate_groups(w.universe().unionByName(w.universe().filter("year = 1997")), ("county_fips", "year"))


@query(
    "qa16_summary_unique_seeded",
    "SELECT county_fips, year, hazard_type, hazard_category, count(*) AS cnt FROM (SELECT * FROM summary UNION ALL SELECT * FROM summary WHERE year = 1998) GROUP BY 1, 2, 3, 4 HAVING count(*) > 1",
)
def _(w: Workspace) -> DataFrame:
    twice = w.summary().unionByName(w.summary().filter("year = 1998"))
    return checks.duplicate_groups(twice, ("county_fips", "year", "hazard_type", "hazard_category"))


@query(
    "qa17_summary_negative_seeded",
    f"SELECT {_SUMMARY_NEGATIVE} FROM summary WHERE year = 1999 ORDER BY county_fips, hazard_type, hazard_category LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    spoilt = w.summary().withColumn("event_count", F.when(F.col("year") == 1999, -1 - F.col("event_count")).otherwise(F.col("event_count")))
    return checks.violations(spoilt, quality.SUMMARY_METRICS, 50, ["county_fips", "hazard_type", "hazard_category"])


@query(
    "qa19_mart_unique_seeded",
    "SELECT county_fips, year, count(*) AS cnt FROM (SELECT county_fips, year FROM scaffold UNION ALL SELECT county_fips, year FROM scaffold WHERE noaa_event_count > 0) GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(w: Workspace) -> DataFrame:
    twice = w.scaffold().unionByName(w.scaffold().filter("noaa_event_count > 0"))
    return checks.duplicate_groups(twice, ("county_fips", "year"))


@query(
    "qa20_mart_negative_seeded",
    "SELECT county_fips, year, -1.0 - fema_total_damage AS fema_total_damage FROM mart WHERE year = 1998 ORDER BY county_fips LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    spoilt = w.mart().withColumn("fema_total_damage", F.when(F.col("year") == 1998, -1.0 - F.col("fema_total_damage")).otherwise(F.col("fema_total_damage")))
    return checks.violations(spoilt, quality.MART_METRICS, 50, ["county_fips"]).select("county_fips", "year", "fema_total_damage")


@query("qa18_rowcounts_equal", "SELECT u.n AS universe_rows, m.n AS mart_rows FROM (SELECT count(*) AS n FROM universe) u, (SELECT count(*) AS n FROM mart) m WHERE u.n <> m.n")
def _(w: Workspace) -> DataFrame:
    return checks.row_counts_equal(w.universe(), w.mart(), ("universe_rows", "mart_rows"))


@query("qa19_mart_unique", "SELECT county_fips, year, count(*) AS cnt FROM scaffold GROUP BY 1, 2 HAVING count(*) > 1")
def _(w: Workspace) -> DataFrame:
    return checks.duplicate_groups(w.scaffold(), ("county_fips", "year"))


@query("qa20_mart_negative_sample", f"SELECT {', '.join(schemas.FEATURE_MART_COLUMNS)} FROM mart WHERE " + " OR ".join(f"{c} < 0" for c in quality.MART_METRICS) + " LIMIT 50")
def _(w: Workspace) -> DataFrame:
    return checks.violations(w.mart(), quality.MART_METRICS)


def _pct(c: str, out: str) -> str:
    return f"100.0 * sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*) AS {out}"


@query(
    "qa21_mart_coverage",
    "SELECT * FROM (SELECT count(*) AS rows, " + ", ".join(_pct(c, f"pct_null_{c}") for c in quality.COVERED) + " FROM mart) WHERE rows = 0 OR "
    + " OR ".join(f"pct_null_{c} > 5" for c in quality.COVERED),
)
def _(w: Workspace) -> DataFrame:
    return quality.coverage_failures(w.mart())


@query("qa22_claim_negative_sample", f"SELECT county_fips, year FROM equal_shares WHERE " + " OR ".join(f"{c} < 0" for c in quality.CLAIM_METRICS) + " LIMIT 50")
def _(w: Workspace) -> DataFrame:
    shares = allocate.allocate_equally(w.claims(), w.declarations())
    return checks.violations(shares, quality.CLAIM_METRICS).select("county_fips", "year")


@query(
    "qa22_claim_negative_seeded",
    f"SELECT county_fips, year, round(-1.0 - {quality.CLAIM_METRICS[0]}, 4) AS {quality.CLAIM_METRICS[0]} FROM equal_shares WHERE year = 1998 AND {quality.CLAIM_METRICS[0]} >= 0 ORDER BY county_fips LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    metric = quality.CLAIM_METRICS[0]
    shares = allocate.allocate_equally(w.claims(), w.declarations())
    spoilt = shares.withColumn(metric, F.when((F.col("year") == 1998) & (F.col(metric) >= 0), -1.0 - F.col(metric)).otherwise(F.col(metric)))
    return checks.violations(spoilt, quality.CLAIM_METRICS, 50, ["county_fips"]).select("county_fips", "year", F.round(metric, 4).alias(metric))


_MATCH = (
    "SELECT *, CASE WHEN claim_disaster_cnt = 0 THEN 0.0 ELSE 1.0 * matched_disaster_cnt / claim_disaster_cnt END AS match_rate FROM (SELECT "
    "(SELECT count(DISTINCT disasternumber) FROM claims) AS claim_disaster_cnt, (SELECT count(DISTINCT disasternumber) FROM declarations) AS decl_disaster_cnt, "
    "(SELECT count(DISTINCT c.disasternumber) FROM claims c JOIN declarations d USING (disasternumber)) AS matched_disaster_cnt, "
    "(SELECT count(DISTINCT c.disasternumber) FROM claims c WHERE c.disasternumber NOT IN (SELECT disasternumber FROM declarations WHERE disasternumber IS NOT NULL)) AS unmatched_claim_disaster_cnt)"
)


@query("qa23_claims_join_coverage", _MATCH)
def _(w: Workspace) -> DataFrame:
    return quality.claims_match(w.claims(), w.declarations())


@query("qa23_claims_join_coverage_failures", f"SELECT * FROM ({_MATCH}) WHERE claim_disaster_cnt = 0 OR match_rate < 0.90")
def _(w: Workspace) -> DataFrame:
    return quality.claims_match_failures(w.claims(), w.declarations())


@query("qa23_claims_join_coverage_failures_seeded", f"SELECT * FROM ({_MATCH.replace('declarations', '(SELECT * FROM declarations WHERE disasternumber % 2 = 0)')}) WHERE claim_disaster_cnt = 0 OR match_rate < 0.90")
def _(w: Workspace) -> DataFrame:
    return quality.claims_match_failures(w.claims(), w.declarations().filter("disasternumber % 2 = 0"))


_SCORES = tuple(schemas.NRI_SCORES.values())


@query(
    "qa24_score_parse_sanity",
    "SELECT * FROM (SELECT count(*) AS rows, " + ", ".join(_pct(c, f"pct_null_{c}") for c in _SCORES) + " FROM nri_county) WHERE rows = 0 OR "
    + " OR ".join(f"pct_null_{c} > 5" for c in _SCORES),
)
def _(w: Workspace) -> DataFrame:
    return quality.coverage_failures(gold.county_scores(w.scores()), _SCORES)


def _rows_of(sql: str) -> str:
    return f"(SELECT count(*) FROM ({sql}))"


def _grown(source: str, grain: str) -> str:
    return _rows_of(f"SELECT 1 FROM {source} GROUP BY {grain} HAVING count(*) > 1")


def _sampled_negative(source: str, columns: tuple[str, ...]) -> str:
    return _rows_of(f"SELECT 1 FROM {source} WHERE " + " OR ".join(f"{c} < 0" for c in columns) + " LIMIT 50")


def _null_share(source: str, columns: tuple[str, ...]) -> str:
    over = " OR ".join(f"100.0 * (count(*) - count({c})) / count(*) > 5" for c in columns)
    return f"(SELECT CASE WHEN count(*) = 0 OR {over} THEN 1 ELSE 0 END FROM {source})"


# The metrics and covered columns of the checks, written out apart from the engine's lists.
_SCAFFOLD_CHECKS = {
    "unmapped_hazards": _rows_of("SELECT DISTINCT event_type FROM events_clean WHERE event_type NOT IN (SELECT event_type FROM type_map)"),
    "county_dim_unique": _grown("dim", "county_fips"),
    "universe_rowcount": _rows_of("SELECT 1 FROM (SELECT (SELECT count(*) FROM dim) * (SELECT count(*) FROM years) AS n, (SELECT count(*) FROM universe) AS u) WHERE n <> u"),
    "universe_unique": _grown("universe", "county_fips, year"),
    "summary_unique": _grown("summary_lenient", "county_fips, year, hazard_type, hazard_category"),
    "summary_nonnegative": _sampled_negative("summary_lenient", ("event_count", "total_fatalities", "total_injuries", "avg_property_damage")),
    "mart_rowcount": _rows_of("SELECT 1 FROM (SELECT (SELECT count(*) FROM universe) AS u, (SELECT count(*) FROM scaffold) AS m) WHERE u <> m"),
    "mart_unique": _grown("scaffold", "county_fips, year"),
    "mart_nonnegative": _sampled_negative(
        "scaffold",
        ("noaa_event_count", "noaa_total_fatalities", "noaa_total_injuries", "noaa_avg_property_damage", "fema_valid_registrations", "fema_total_damage", "fema_total_approved_ihp_amount", "fema_declaration_count"),
    ),
    "mart_coverage": _null_share("scaffold", ("nri_risk_score", "nri_resl_score", "population_total", "median_household_income")),
    "claims_nonnegative": _sampled_negative(
        "scaffold",
        ("fema_valid_registrations", "fema_total_damage", "fema_total_approved_ihp_amount", "fema_repair_replace_amount", "fema_rental_amount", "fema_other_needs_amount", "fema_total_inspected"),
    ),
    "claims_match": _rows_of(f"SELECT * FROM ({_MATCH}) WHERE claim_disaster_cnt = 0 OR match_rate < 0.90"),
    "scores_parse": _null_share("nri_county", ("nri_risk_score", "nri_eal_score", "nri_sovi_score", "nri_resl_score")),
}


@query("gt3_scaffold_gate", " UNION ALL ".join(f"SELECT '{name}' AS name, cast({sql} AS BIGINT) AS failures" for name, sql in _SCAFFOLD_CHECKS.items()))
def _(w: Workspace) -> DataFrame:
    suite = quality.legacy_suite(
        w.events(), w.type_map(), w.dim(), w.years(), w.universe(), w.summary_lenient(), w.scaffold(), w.claims(), w.declarations(), gold.county_scores(w.scores())
    )
    return checks.check_frame(w.spark, suite).select("name", "failures")


def _contract_oracle() -> str:
    contract = contracts.RISK_FEATURE_MART
    parts = [
        "SELECT 'columns_present' AS name, 0 AS failures",
        "SELECT 'column_types', 0",
        "SELECT 'grain_unique', (SELECT count(*) FROM (SELECT 1 FROM mart GROUP BY county_fips, year HAVING count(*) > 1))",
    ]
    for c, rule in contract["columns"].items():
        if rule.get("required"):
            parts.append(f"SELECT '{c}__not_null', (SELECT count(*) FROM mart WHERE {c} IS NULL)")
        if rule.get("non_negative"):
            parts.append(f"SELECT '{c}__non_negative', (SELECT count(*) FROM mart WHERE {c} < 0)")
    for columns, limit in contract["null_tolerance"]:
        parts += [
            f"SELECT '{c}__null_pct', (SELECT CASE WHEN count(*) = 0 OR 100.0 * (count(*) - count({c})) / count(*) > {limit} THEN 1 ELSE 0 END FROM mart)"
            for c in columns
        ]
    return "SELECT name, cast(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


@query("qa25_contract", _contract_oracle())
def _(w: Workspace) -> DataFrame:
    suite = Suite("contract", w.mart(), checks.contract_checks(w.mart(), contracts.RISK_FEATURE_MART))
    return checks.check_frame(w.spark, suite).select("name", "failures", "passed")


@query(
    "qa25_contract_summary_seeded",
    "SELECT 'event_count__non_negative' AS name, count(*) FILTER (WHERE year = 1999) AS failures FROM summary",
)
def _(w: Workspace) -> DataFrame:
    spoilt = w.summary().withColumn("event_count", F.when(F.col("year") == 1999, -1 - F.col("event_count")).otherwise(F.col("event_count")))
    suite = Suite("contract", spoilt, checks.contract_checks(spoilt, contracts.HAZARD_EVENT_SUMMARY))
    return checks.check_frame(w.spark, suite).select("name", "failures").filter("failures > 0")


@query("qa25_contract_summary", "SELECT 'event_count__non_negative' AS name, (SELECT count(*) FROM summary WHERE event_count < 0) AS failures UNION ALL SELECT 'grain_unique', "
       "(SELECT count(*) FROM (SELECT 1 FROM summary GROUP BY county_fips, year, hazard_type, hazard_category HAVING count(*) > 1))")
def _(w: Workspace) -> DataFrame:
    suite = Suite("contract", w.summary(), checks.contract_checks(w.summary(), contracts.HAZARD_EVENT_SUMMARY))
    found = checks.check_frame(w.spark, suite).select("name", "failures")
    return found.filter(F.col("name").isin("event_count__non_negative", "grain_unique"))


@query("qa26_known_bad_keys", "SELECT county_fips, count(*) AS rows FROM mart WHERE county_fips IN ('01340', '00390') GROUP BY 1")
def _(w: Workspace) -> DataFrame:
    return quality.known_bad_keys(w.mart())


@query("qa26_known_bad_keys_seeded", "SELECT '01340' AS county_fips, count(*) AS rows FROM mart WHERE county_fips = '04004'")
def _(w: Workspace) -> DataFrame:
    spoilt = w.mart().withColumn("county_fips", F.when(F.col("county_fips") == "04004", "01340").otherwise(F.col("county_fips")))
    return quality.known_bad_keys(spoilt)


@query(
    "qa26_quarantine_counts",
    "SELECT 'events_unresolved' AS table_name, count(*) AS rows FROM classified WHERE county_fips_mapping_method = 'unresolved' UNION ALL "
    "SELECT 'events_non_county', count(*) FROM classified WHERE county_fips_mapping_method = 'non_county_zone' UNION ALL SELECT 'scores_unresolved', count(*) FROM scores_unresolved",
)
def _(w: Workspace) -> DataFrame:
    return quality.quarantine_counts(
        {
            "events_unresolved": w.events("unresolved"),
            "events_non_county": w.events("non_county"),
            "scores_unresolved": w.scores_unresolved(),
        }
    )


@query(
    "qa27_join_success",
    "SELECT count(*) AS total_rows, count(*) FILTER (county_fips IN (SELECT county_fips FROM scores)) AS matched_rows, "
    "1.0 * count(*) FILTER (county_fips IN (SELECT county_fips FROM scores)) / count(*) AS match_rate FROM declarations",
)
def _(w: Workspace) -> DataFrame:
    return checks.share_in_reference(w.declarations(), w.scores())


# --- gate -----------------------------------------------------------------------------------


def _suites(w: Workspace) -> list[Suite]:
    events = w.events()
    mart = w.mart()
    return [
        quality.silver_events_suite(events),
        Suite(
            "mart_with_warning",
            mart,
            [
                Check("year_window", checks.outside_window(WINDOW.first, WINDOW.last)),
                Check("events_present", checks.count_if(F.col("noaa_event_count") == 0), WARNING, "counties without events"),
            ],
        ),
        Suite("mart_broken", mart, [Check("no_such_column", checks.any_null(["absent"]))]),
        Suite(
            "universe_gap",
            mart,
            [Check("county_year_coverage", checks.Covers(w.universe(), ("county_fips", "year")))],
        ),
    ]


_SUITE_SQL = (
    "SELECT 'silver_events' AS suite, 'grain_keys_not_null' AS name, 'blocking' AS severity, 0 AS failures UNION ALL SELECT 'silver_events', 'year_partition_complete', 'blocking', 0 "
    "UNION ALL SELECT 'mart_with_warning', 'year_window', 'blocking', 0 UNION ALL SELECT 'mart_with_warning', 'events_present', 'warning', (SELECT count(*) FROM mart WHERE noaa_event_count = 0) "
    "UNION ALL SELECT 'mart_broken', 'no_such_column', 'blocking', -1 "
    "UNION ALL SELECT 'universe_gap', 'county_year_coverage', 'blocking', (SELECT count(*) FROM universe ANTI JOIN mart USING (county_fips, year))"
)


def _all_results(w: Workspace) -> DataFrame:
    return reduce(DataFrame.unionByName, [checks.check_frame(w.spark, s) for s in _suites(w)])


@query("gt1_suite_run", f"SELECT suite, name, cast(failures AS BIGINT) AS failures, failures = 0 AS passed FROM ({_SUITE_SQL})")
def _(w: Workspace) -> DataFrame:
    return _all_results(w).select("suite", "name", "failures", "passed")


@query(
    "gt2_severity_and_description",
    f"SELECT suite, name, severity, CASE WHEN severity = 'warning' THEN 'counties without events' ELSE '' END AS description FROM ({_SUITE_SQL})",
)
def _(w: Workspace) -> DataFrame:
    return _all_results(w).select("suite", "name", "severity", "description")


_STATUS_SQL = (
    "SELECT suite, CASE WHEN b > 0 THEN 'fail' WHEN n > 0 THEN 'warn' ELSE 'pass' END AS status, b > 0 AS block_downstream, b AS blocking_failures, n AS non_blocking_failures "
    f"FROM (SELECT suite, count(*) FILTER (failures <> 0 AND severity = 'blocking') AS b, count(*) FILTER (failures <> 0 AND severity <> 'blocking') AS n FROM ({_SUITE_SQL}) GROUP BY suite)"
)


@query("gt3_suite_status", _STATUS_SQL)
def _(w: Workspace) -> DataFrame:
    return checks.suite_status(_all_results(w))


@query("gt4_empty_suite_passes", "SELECT 'pass' AS status, false AS block_downstream, count(*) AS mart_rows FROM mart")
def _(w: Workspace) -> DataFrame:
    empty = checks.check_frame(w.spark, Suite("empty", w.mart()))
    rows = w.mart().agg(F.count("*")).scalar()
    return checks.overall_status(checks.suite_status(empty)).withColumn("mart_rows", rows)


@query(
    "gt5_overall_status",
    f"SELECT CASE max(CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status, bool_or(block_downstream) AS block_downstream FROM ({_STATUS_SQL})",
)
def _(w: Workspace) -> DataFrame:
    return checks.overall_status(checks.suite_status(_all_results(w)))


@query("gt6_publish_and_promote", "SELECT county_fips, year, noaa_event_count, fema_total_damage FROM mart")
def _(w: Workspace) -> DataFrame:
    good = publish.publish_version(
        w.mart(),
        "risk_feature_mart",
        "2024-01-31",
        f"{scratch_dir(w.spark, 'gt6')}/run_dt=2024-01-31",
        lambda t: quality.mart_suite(t, w.mart(), w.mart(), WINDOW),
    )
    bad = publish.publish_version(
        w.mart().withColumn("year", F.lit(1900)),
        "risk_feature_mart",
        "2024-02-29",
        f"{scratch_dir(w.spark, 'gt6')}/run_dt=2024-02-29",
        lambda t: quality.mart_suite(t, w.mart(), w.mart(), WINDOW),
    )
    if not good.promoted or bad.promoted:
        raise AssertionError("the gate let the wrong version through")
    return w.spark.table("default.risk_feature_mart_current").select(
        "county_fips", "year", "noaa_event_count", "fema_total_damage"
    )


@query("gt6_rerun_of_one_date", "SELECT county_fips, year, noaa_event_count FROM mart")
def _(w: Workspace) -> DataFrame:
    """A bad second run of a date leaves the good version of that date in view."""
    path = f"{scratch_dir(w.spark, 'gt6-rerun')}/run_dt=2024-03-31"
    suite = lambda t: quality.mart_suite(t, w.mart(), w.mart(), WINDOW)
    publish.publish_version(w.mart(), "risk_feature_mart", "2024-03-31", path, suite)
    bad = publish.publish_version(w.mart().filter("year <> 1998"), "risk_feature_mart", "2024-03-31", path, suite)
    if bad.promoted:
        raise AssertionError("the gate let the wrong version through")
    return w.spark.table("default.risk_feature_mart_current").select("county_fips", "year", "noaa_event_count")


def _run_log(w: Workspace) -> DataFrame:
    """Quality report of each suite appended to a log, then read back."""
    path = scratch_dir(w.spark, "run_log")
    rows = checks.suite_status(_all_results(w)).select(
        F.current_timestamp().alias("logged_at"),
        F.lit("run-1").alias("run_id"),
        F.lit("gold").alias("layer"),
        F.lit("quality").alias("kind"),
        F.col("suite").alias("name"),
        "status",
        "block_downstream",
        F.to_json(F.struct("blocking_failures", "non_blocking_failures")).alias("payload"),
        F.lit("2024-01-31").cast("date").alias("run_dt"),
    )
    publish.append_log(rows, path)
    return publish.read_log(w.spark, path)


@query("gt7_upstream_blocks", f"SELECT suite AS name, status FROM ({_STATUS_SQL}) WHERE block_downstream")
def _(w: Workspace) -> DataFrame:
    return publish.blocking_reports(_run_log(w), "gold", "2024-01-31").select("name", "status")


@query(
    "gt8_run_log",
    f"SELECT 'run-1' AS run_id, suite AS name, status, blocking_failures, date '2024-01-31' AS run_dt FROM ({_STATUS_SQL})",
)
def _(w: Workspace) -> DataFrame:
    failures = F.get_json_object("payload", "$.blocking_failures").cast("bigint").alias("blocking_failures")
    return _run_log(w).select("run_id", "name", "status", failures, "run_dt")


# --- audits ------------------------------------------------------------------------------------

_UNSCORED = (
    "(SELECT m.*, CASE WHEN n.county_fips IS NULL THEN 'missing_in_nri_reference' WHEN try_cast(n.risk_score AS DOUBLE) IS NULL THEN 'present_in_nri_but_score_null' "
    "ELSE 'unexpected_null_after_join' END AS nri_join_status FROM (SELECT * FROM mart WHERE nri_risk_score IS NULL) m LEFT JOIN scores n ON m.county_fips = trim(n.county_fips))"
)


@query(
    "au1_null_summary",
    "SELECT nri_join_status, CASE WHEN noaa_event_count > 0 AND fema_valid_registrations > 0 THEN 'noaa_and_fema' WHEN noaa_event_count > 0 THEN 'noaa_only' "
    f"WHEN fema_valid_registrations > 0 THEN 'fema_only' ELSE 'neither_noaa_nor_fema' END AS feature_presence, substr(county_fips, 1, 2) AS state_fips, count(*) AS rows FROM {_UNSCORED} GROUP BY 1, 2, 3",
)
def _(w: Workspace) -> DataFrame:
    return audits.null_summary(w.mart(), w.scores())


@query(
    "au2_null_counties",
    "SELECT county_fips, substr(county_fips, 1, 2) AS state_fips, nri_join_status, count(*) AS null_year_rows, min(year) AS first_year, max(year) AS last_year, "
    f"cast(sum(noaa_event_count) AS BIGINT) AS total_noaa_events, sum(fema_valid_registrations) AS total_fema_registrations FROM {_UNSCORED} GROUP BY 1, 2, 3",
)
def _(w: Workspace) -> DataFrame:
    return audits.null_counties(w.mart(), w.scores())


@query(
    "au3_null_details",
    "SELECT county_fips, year, noaa_event_count, fema_valid_registrations, coalesce(population_total, 0) AS population_total, nri_join_status "
    f"FROM {_UNSCORED} ORDER BY noaa_event_count DESC, fema_valid_registrations DESC, county_fips, year LIMIT 100",
)
def _(w: Workspace) -> DataFrame:
    return audits.null_details(w.mart(), w.scores())


# --- landing -------------------------------------------------------------------------------------


@query(
    "ld1_landing_manifest",
    "SELECT count(*) AS landed_rows, true AS sizes_known, true AS hashes_known FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    manifest = landing.landing_manifest(w.spark, _event_csv(w, "none"), "2024-01-31")
    return manifest.agg(
        F.sum("row_count").alias("landed_rows"),
        F.bool_and(F.col("bytes") > 0).alias("sizes_known"),
        F.bool_and(F.length("sha256") == 64).alias("hashes_known"),
    )


def _manifest(w: Workspace) -> DataFrame:
    """Listing rows of the earlier half of each year stand for files already landed."""
    return _listing(w).filter("substr(name, instr(name, '_c2024') + 6, 2) <= '06'")


_LANDED = f"(SELECT * FROM (SELECT {_LISTING} AS name, o_orderkey AS bytes FROM orders) WHERE substr(name, instr(name, '_c2024') + 6, 2) <= '06')"


@query("ld2_not_landed", f"SELECT name, bytes FROM (SELECT {_LISTING} AS name, o_orderkey AS bytes FROM orders) ANTI JOIN {_LANDED} USING (name, bytes)")
def _(w: Workspace) -> DataFrame:
    return landing.not_landed(_listing(w), _manifest(w))


@query(
    "ld2_landing_status",
    f"SELECT CASE WHEN l.name IS NULL THEN 'NEW' ELSE 'SKIPPED_EXISTS' END AS status, count(*) AS n FROM (SELECT {_LISTING} AS name, o_orderkey AS bytes FROM orders) a LEFT JOIN {_LANDED} l USING (name, bytes) GROUP BY 1",
)
def _(w: Workspace) -> DataFrame:
    return landing.with_landing_status(_listing(w), _manifest(w)).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "ld3_missing_pairs",
    "SELECT cast(y.year AS INT) AS year, t.filetype FROM (SELECT unnest(generate_series(1994, 2003)) AS year) y, (VALUES ('details'), ('fatalities'), ('locations')) t(filetype) "
    f"WHERE NOT EXISTS (SELECT 1 FROM (SELECT {_LISTING} AS name FROM orders) o WHERE contains(o.name, t.filetype) AND contains(o.name, '_d' || y.year || '_'))",
)
def _(w: Workspace) -> DataFrame:
    years = landing.year_scope(w.spark, "backfill", "2024-01-31", 1994, 2003)
    return landing.missing_pairs(landing.parse_listing(_listing(w)), years, ("details", "fatalities", "locations"))


@query(
    "ld4_presence_checks",
    "SELECT name, bytes IS NULL AS missing, coalesce(bytes = 0, false) AS zero_size, coalesce(n < 3, false) AS too_few_rows FROM "
    f"(SELECT DISTINCT name FROM (SELECT {_LISTING} AS name FROM orders)) e LEFT JOIN "
    f"(SELECT name, min(CASE WHEN day = 7 THEN 0 ELSE bytes END) AS bytes, count(*) AS n FROM (SELECT {_LISTING} AS name, o_orderkey AS bytes, day(o_orderdate) AS day FROM orders) WHERE day <> 3 GROUP BY name) f USING (name)",
)
def _(w: Workspace) -> DataFrame:
    # files of the third of a month never landed, those of the seventh are empty
    landed = w.table("orders").selectExpr(f"{_LISTING} AS name", "o_orderkey AS bytes", "day(o_orderdate) AS day").filter("day <> 3")
    files = landed.groupBy("name").agg(F.min(F.when(F.col("day") == 7, 0).otherwise(F.col("bytes"))).alias("bytes"), F.count("*").alias("row_count"))
    return landing.presence_checks(files, _listing(w).select("name").distinct(), 3)


@query(
    "ld5_dataset_sizes",
    "SELECT dataset, count(*) AS file_count, cast(sum(bytes) AS BIGINT) AS total_bytes, array_to_string(list_sort(list(name) FILTER (rn <= 10)), ',') AS sample_files FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY name) AS rn FROM (SELECT {_LISTING} AS name, o_orderkey AS bytes, o_orderpriority AS dataset FROM orders)) GROUP BY dataset",
)
def _(w: Workspace) -> DataFrame:
    files = w.table("orders").selectExpr(f"{_LISTING} AS name", "o_orderkey AS bytes", "o_orderpriority AS dataset")
    sizes = landing.dataset_sizes(files)
    return sizes.select("dataset", "file_count", "total_bytes", F.array_join("sample_files", ",").alias("sample_files"))


@query("ld6_source_ready", "SELECT count(*) > 0 AS ready FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return landing.is_ready(landing.list_files(w.spark, _event_csv(w, "none"), "*.csv"))


# --- serving --------------------------------------------------------------------------------------


@query("sq01_available_years", "SELECT DISTINCT year FROM mart")
def _(w: Workspace) -> DataFrame:
    return serving.available_years(w.mart())


@query(
    "sq02_health_counts",
    f"SELECT '{YEAR}' AS selected_year, (SELECT count(*) FROM mart WHERE year = {YEAR}) AS risk_rows_year, (SELECT count(*) FROM centroids) AS centroid_rows, "
    f"(SELECT count(*) FROM summary WHERE year = {YEAR}) AS noaa_rows_year",
)
def _(w: Workspace) -> DataFrame:
    return serving.health_counts(w.mart(), w.centroids(), w.summary(), YEAR)


_KPIS = (
    "100.0 * avg(CASE WHEN noaa_event_count = 0 THEN 1.0 ELSE 0.0 END) AS pct_noaa_zero, "
    "quantile_disc(nri_risk_score, 0.5) FILTER (noaa_event_count = 0) AS median_nri_noaa_zero, "
    "quantile_disc(nri_risk_score, 0.5) FILTER (noaa_event_count > 0) AS median_nri_noaa_pos"
)


@query("sq03_year_kpis", f"SELECT {_KPIS} FROM mart WHERE year = {YEAR}")
def _(w: Workspace) -> DataFrame:
    return serving.kpis_of_year(w.mart(), YEAR)


@query("sq03_kpis_all_years", f"SELECT year, {_KPIS} FROM mart GROUP BY year")
def _(w: Workspace) -> DataFrame:
    return serving.year_kpis(w.mart())


_RANK = ", ".join(ranking.RANK_COLUMNS)


@query(
    "sq04_quiet_but_risky",
    f"SELECT {_RANK} FROM mart WHERE year = 1997 AND noaa_event_count = 0 ORDER BY nri_risk_score DESC NULLS LAST, fema_valid_registrations DESC, county_fips LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    return serving.ranking.quiet_but_risky(w.mart(), 1997, 50)


@query("sq05_county_lookup", f"SELECT county_fips, county_name, state, lat, lon FROM centroids WHERE county_fips = '{COUNTY}' LIMIT 1")
def _(w: Workspace) -> DataFrame:
    return serving.county_lookup(w.centroids(), " 04-004 ")


@query("sq06_directory_search", "SELECT county_fips, county_name, state FROM centroids WHERE contains(lower(county_name), 'city')")
def _(w: Workspace) -> DataFrame:
    return serving.search_directory(w.centroids(), "CITY")


_PER_EVENT = "fema_valid_registrations / nullif(cast(noaa_event_count AS DOUBLE), 0.0)"


@query(
    "sq07_claim_intensity",
    f"SELECT county_fips, year, fema_valid_registrations, noaa_event_count, round({_PER_EVENT}, 2) AS claims_per_event FROM mart WHERE year = 1999 ORDER BY claims_per_event DESC NULLS LAST, county_fips LIMIT 25",
)
def _(w: Workspace) -> DataFrame:
    return ranking.claim_intensity(w.mart(), 1999, 1999, 25)


@query(
    "sq08_hazard_breakdown",
    "SELECT hazard_type, hazard_category, event_count, total_fatalities, total_injuries, avg_property_damage FROM summary WHERE county_fips = '04004' AND year = 1999 "
    "ORDER BY event_count DESC, hazard_type, hazard_category LIMIT 50",
)
def _(w: Workspace) -> DataFrame:
    return ranking.hazard_breakdown(w.summary(), "04-004", 1999, 50)


@query(
    "sq09_ranking_modes",
    " UNION ALL ".join(
        f"SELECT '{mode}' AS mode, * FROM (SELECT {_RANK} FROM mart WHERE year = 1997 ORDER BY "
        + ", ".join(f"{c} DESC NULLS LAST" for c in order)
        + ", county_fips LIMIT 50)"
        for mode, order in ranking.RANK_MODES.items()
    ),
)
def _(w: Workspace) -> DataFrame:
    ranked = [
        ranking.rank_counties(w.mart(), mode, 1997, 50).select(F.lit(mode).alias("mode"), *ranking.RANK_COLUMNS)
        for mode in ranking.RANK_MODES
    ]
    return reduce(DataFrame.unionByName, ranked)


_ROLL = "OVER (PARTITION BY county_fips ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
_SERIES = (
    "SELECT county_fips, year, cast(noaa_event_count AS DOUBLE) AS noaa_event_count, fema_valid_registrations, fema_total_damage, nri_risk_score, "
    f"avg(cast(noaa_event_count AS DOUBLE)) {_ROLL} AS noaa_events_roll5, avg(fema_valid_registrations) {_ROLL} AS fema_regs_roll5, avg(fema_total_damage) {_ROLL} AS fema_damage_roll5, "
    f"{_PER_EVENT} AS claims_per_event FROM mart"
)


@query("sq10_county_series", f"{_SERIES} WHERE county_fips = '{COUNTY}'")
def _(w: Workspace) -> DataFrame:
    return serving.county_series(w.mart(), COUNTY)


@query(
    "sq11_ranked_with_centroids",
    f"SELECT r.*, c.lat, c.lon, c.county_name, c.state FROM (SELECT {_RANK} FROM mart WHERE year = {YEAR} ORDER BY nri_risk_score DESC NULLS LAST, county_fips LIMIT 300) r LEFT JOIN centroids c USING (county_fips)",
)
def _(w: Workspace) -> DataFrame:
    return serving.ranked_with_centroids(ranking.rank_counties(w.mart(), "structural", YEAR, 300), w.centroids())


@query("sq12_claims_per_event", _SERIES)
def _(w: Workspace) -> DataFrame:
    return serving.county_series(w.mart())


@query(
    "sq13_quiet_share",
    f"SELECT 100.0 * avg(CASE WHEN noaa_event_count = 0 THEN 1.0 ELSE 0.0 END) AS zero_event_pct FROM (SELECT * FROM mart WHERE year = {YEAR} ORDER BY fema_total_damage DESC, fema_valid_registrations DESC, county_fips LIMIT 1000)",
)
def _(w: Workspace) -> DataFrame:
    return serving.quiet_share(ranking.rank_counties(w.mart(), "impact", YEAR, 1000))


@query(
    "sq14_map_payload",
    "WITH p AS (SELECT r.*, c.lat, c.lon, c.county_name, c.state FROM "
    f"(SELECT {_RANK} FROM mart WHERE year = {YEAR} ORDER BY noaa_event_count DESC, fema_valid_registrations DESC, county_fips LIMIT 1000) r LEFT JOIN centroids c USING (county_fips) "
    "WHERE lat IS NOT NULL AND lon IS NOT NULL ORDER BY noaa_event_count DESC, fema_valid_registrations DESC, county_fips LIMIT 500) "
    "SELECT county_fips, year, lat, lon, county_name, state, 2000.0 + 38000.0 * (fema_valid_registrations / (SELECT max(fema_valid_registrations) FROM p)) AS radius, "
    "cast(trunc(greatest(50.0, least(230.0, 50.0 + 180.0 * (cast(noaa_event_count AS DOUBLE) / (SELECT max(noaa_event_count) FROM p))))) AS INT) AS colour_index FROM p".replace("WITH p", "SELECT * FROM (WITH p", 1)
    + ")",
)
def _(w: Workspace) -> DataFrame:
    points = serving.map_payload(
        w.mart(), w.centroids(), "frequency", YEAR, "noaa_event_count", "fema_valid_registrations", cap=500
    )
    return points.select("county_fips", "year", "lat", "lon", "county_name", "state", "radius", "colour_index")


@query(
    "sq15_county_snapshot",
    "SELECT county_fips, max(year) AS year, arg_max(nri_risk_score, year) AS nri_risk_score, arg_max(noaa_event_count, year) AS noaa_event_count, "
    "arg_max(fema_valid_registrations, year) AS fema_valid_registrations, arg_max(fema_total_damage, year) AS fema_total_damage FROM mart GROUP BY county_fips",
)
def _(w: Workspace) -> DataFrame:
    return serving.county_snapshot(w.mart())


@query("sq16_top_mean_risk", "SELECT county_fips, round(avg(nri_risk_score), 2) AS avg_risk FROM mart GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10")
def _(w: Workspace) -> DataFrame:
    top = ranking.top_by_mean(w.mart(), limit=10)
    return top.withColumn("avg_risk", F.round("avg_risk", 2))


@query(
    "sq16_intensity_over_years",
    f"SELECT county_fips, year, fema_valid_registrations, noaa_event_count, round({_PER_EVENT}, 0) AS claims_per_event FROM mart WHERE year BETWEEN 1997 AND 2000 ORDER BY claims_per_event DESC NULLS LAST, county_fips, year LIMIT 25",
)
def _(w: Workspace) -> DataFrame:
    return ranking.claim_intensity(w.mart(), 1997, 2000, 25, 0)
