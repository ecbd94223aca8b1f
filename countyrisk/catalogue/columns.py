"""Queries: sources, sinks, column clean-up, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import casts, damage, display, names
from ..operators import ranking
from ..plans import silver
from ..session import scratch_dir
from ..sinks import commits, tables
from ..sources import files, landing
from . import adapters
from .oracle import blank, lenient, report_time, strict, zsum
from .registry import query
from .workspace import Workspace

EVENT_TEXT = ("event_id", "cz_name", "year", "damage_property", "injuries_direct")


def _csv(df: DataFrame, path: str, **options: str) -> None:
    """CSV as landed: blanks around values are kept, as in the sources."""
    keep = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(**keep, **options).csv(path)


def _event_csv(w: Workspace, compression: str) -> str:
    return w.written(
        f"csv_events_{compression}",
        lambda p: _csv(w.raw("events"), p, compression=compression),
    )


# --- sources ---------------------------------------------------------------------


@query("src01_csv_text", "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in EVENT_TEXT) + " FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return files.read_csv_text(w.spark, _event_csv(w, "none")).select(*EVENT_TEXT)


@query("src02_gzip_csv", "SELECT event_type, count(*) AS n FROM raw_events GROUP BY event_type")
def _(w: Workspace) -> DataFrame:
    return files.read_csv_gz(w.spark, _event_csv(w, "gzip")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("src03_crosswalk_fixed_schema", "SELECT zip, county, year, nullif(tot_ratio, '') AS tot_ratio, top_match FROM raw_crosswalk")
def _(w: Workspace) -> DataFrame:
    raw = w.raw("crosswalk")
    # another header order, and columns that aren't asked for
    shuffled = raw.select("county", "zip", F.lit("PRATTVILLE").alias("USPS City"), "tot_ratio", "year", F.lit("0.1").alias("res_ratio"), "top_match")
    path = w.written("csv_crosswalk", lambda p: _csv(shuffled, p))
    return files.read_crosswalk(w.spark, path)


@query(
    "src04_partition_discovery",
    "SELECT year, count(*) AS n FROM summary WHERE year BETWEEN 1997 AND 1999 GROUP BY year",
)
def _(w: Workspace) -> DataFrame:
    w.summary()
    rows = files.read_parquet(w.spark, f"{w.root}/summary")
    return rows.filter("year BETWEEN 1997 AND 1999").groupBy("year").agg(F.count("*").alias("n"))


@query("src05_quoted_csv", "SELECT event_type, hazard_group, hazard_subgroup FROM raw_type_map")
def _(w: Workspace) -> DataFrame:
    path = w.written(
        "csv_type_map",
        lambda p: _csv(w.type_map(), p, quote='"', escape="\\"),
    )
    return files.read_csv_typed(w.spark, path, schemas.HAZARD_TYPE_MAP)


def _bronze(w: Workspace, raw: DataFrame, dataset: str) -> DataFrame:
    """A raw frame written under its own messy headers, in reverse order, with columns that
    aren't declared and those that are declared but not in the frame; read by the typed reader."""
    present = set(names.normalize_columns(raw).columns)
    absent = [F.lit(None).cast("string").alias(f.name.upper()) for f in schemas.BRONZE[dataset] if f.name not in present]
    path = w.written(f"csv_{dataset}", lambda p: _csv(raw.select(F.lit("?").alias("Not Declared"), *reversed(raw.columns), *absent), p))
    return files.read_bronze(w.spark, path, dataset)


_SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}


def _bronze_query(name: str, raw: str, dataset: str) -> None:
    """All declared columns of a data set."""
    present = set(adapters.columns(raw))
    typed = []
    for field in schemas.BRONZE[dataset]:
        kind = _SQL_TYPES[field.dataType.simpleString()]
        value = f"nullif({field.name}, '')" if field.name in present else "NULL"
        typed.append(f"try_cast({value} AS {kind}) AS {field.name}")

    @query(f"src06_typed_{name}", f"SELECT {', '.join(typed)} FROM raw_{raw}")
    def _(w: Workspace) -> DataFrame:
        return _bronze(w, w.raw(raw), dataset)


_bronze_query("declarations", "declarations", "disaster_declarations")
_bronze_query("owners", "owners", "housing_assistance_owners")
_bronze_query("renters", "renters", "housing_assistance_renters")
_bronze_query("scores", "nri", "nri_counties")
for _table in silver.CENSUS_CELLS:
    _bronze_query(_table, _table, f"acs5_2022_{_table}")


@query("src07_repeated_headers", "SELECT year, event_id AS year__dup1, cz_name AS name, state AS name__dup1 FROM raw_events")
def _(w: Workspace) -> DataFrame:
    read = w.raw("events").select("YEAR", "EVENT_ID", "CZ_NAME", "STATE").toDF("YEAR0", "Year1", "NAME2", "NAME3")
    return names.normalize_header(read, ("year", "name"))


@query("src08_feature_pages", "SELECT c_custkey AS objectid, c_name AS county, c_acctbal AS risk_score FROM customer")
def _(w: Workspace) -> DataFrame:
    feature = F.struct(F.struct(F.col("c_custkey").alias("OBJECTID"), F.col("c_name").alias("COUNTY"), F.col("c_acctbal").alias("RISK_SCORE")).alias("attributes"))
    pages = (
        w.table("customer")
        .groupBy(F.floor(F.col("c_custkey") / 100).alias("page"))
        .agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    )
    return files.decode_feature_pages(pages, "OBJECTID bigint, COUNTY string, RISK_SCORE double")


@query("src09_header_arrays", "SELECT name, b01001_001e, state, county FROM raw_b01001")
def _(w: Workspace) -> DataFrame:
    wanted = ["NAME", "B01001_001E", "state", "county"]
    exprs = adapters.RAW["b01001"][1]
    rows = w.table("customer").selectExpr("floor(c_custkey / 100) AS page", *[f"{exprs[c]} AS `{c}`" for c in wanted])
    document = F.concat(
        F.array(F.array(*[F.lit(c) for c in wanted])), F.collect_list(F.array(*[F.col(c) for c in wanted]))
    )
    pages = rows.groupBy("page").agg(F.to_json(document).alias("value"))
    return files.decode_header_arrays(pages, wanted)


@query("src08_landed_pages", "SELECT c_custkey AS objectid, c_name AS county, c_acctbal AS risk_score FROM customer")
def _(w: Workspace) -> DataFrame:
    """Pages as landed files, read piecewise; members in front of the features and behind them are skipped."""
    attributes = F.struct(F.col("c_custkey").alias("OBJECTID"), F.col("c_name").alias("COUNTY"), F.col("c_acctbal").alias("RISK_SCORE"))
    features = F.collect_list(F.struct(attributes.alias("attributes")))
    page = F.struct(F.struct(F.lit(4326).alias("wkid")).alias("spatialReference"), features.alias("features"), F.lit(False).alias("exceededTransferLimit"))

    def write(path: str) -> None:
        pages = w.table("customer").groupBy(F.floor(F.col("c_custkey") / 100).alias("page")).agg(F.to_json(page).alias("value"))
        pages.repartition("page").write.partitionBy("page").text(path)

    return files.read_feature_pages(w.spark, w.written("landed_pages", write), "OBJECTID bigint, COUNTY string, RISK_SCORE double")


@query("src10_file_path", "SELECT cast(year AS VARCHAR) AS folder_year, count(*) AS n FROM summary GROUP BY year")
def _(w: Workspace) -> DataFrame:
    year = F.regexp_extract("source_path", r"year=(\d+)", 1)
    return files.with_file_path(w.summary()).groupBy(year.alias("folder_year")).agg(F.count("*").alias("n"))


_LISTING = (
    "concat('StormEvents_', CASE o_orderkey % 3 WHEN 0 THEN 'details' WHEN 1 THEN 'fatalities' ELSE 'locations' END, "
    "'-ftp_v1.0_d', cast(year(o_orderdate) as string), '_c2024', lpad(cast(month(o_orderdate) as string), 2, '0'), "
    "lpad(cast(day(o_orderdate) as string), 2, '0'), '.csv.gz')"
)


def _listing(w: Workspace) -> DataFrame:
    return w.table("orders").selectExpr(f"{_LISTING} AS name", "o_orderkey AS bytes")


@query(
    "src11_latest_file",
    f"SELECT regexp_extract(name, '_(details|fatalities|locations)-', 1) AS filetype, cast(regexp_extract(name, '_d([0-9]+)_', 1) AS INT) AS year, "
    f"max(name) AS name, max(regexp_extract(name, '_c([0-9]+)', 1)) AS stamp FROM (SELECT {_LISTING} AS name FROM orders) GROUP BY 1, 2",
)
def _(w: Workspace) -> DataFrame:
    return landing.latest_files(_listing(w))


@query("src12_year_scope", "SELECT year, count(*) AS n FROM events_clean WHERE year BETWEEN 1996 AND 1998 GROUP BY year")
def _(w: Workspace) -> DataFrame:
    scope = landing.year_scope(w.spark, "backfill", "2024-01-31", 1996, 1998)
    return w.events().join(scope, "year", "left_semi").groupBy("year").agg(F.count("*").alias("n"))


# --- sinks -------------------------------------------------------------------------

_RUN_DT = "2024-01-31"
_SUMMARY_COLUMNS = ", ".join(schemas.SUMMARY_COLUMNS)


def _per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(F.count("*").alias("n"), F.sum("event_count").alias("event_count"))


_PER_YEAR = "SELECT year, count(*) AS n, cast(sum(event_count) AS BIGINT) AS event_count FROM summary GROUP BY year"


@query("snk01_partitioned_overwrite", _PER_YEAR)
def _(w: Workspace) -> DataFrame:
    path = scratch_dir(w.spark, "snk01")
    tables.write_partitioned(w.summary().withColumn("event_count", F.lit(0)), path)
    tables.write_partitioned(w.summary(), path)
    return _per_year(w.spark.read.parquet(path))


@query(
    "snk01_incremental_years",
    "SELECT year, count(*) AS n, cast(sum(CASE WHEN year = 1998 THEN event_count ELSE 0 END) AS BIGINT) AS event_count FROM summary GROUP BY year",
)
def _(w: Workspace) -> DataFrame:
    path = scratch_dir(w.spark, "snk01i")
    tables.write_partitioned(w.summary().withColumn("event_count", F.lit(0).cast("bigint")), path)
    tables.write_partitioned(w.summary().filter("year = 1998"), path, incremental=True)
    return _per_year(w.spark.read.parquet(path))


@query("snk02_plain_overwrite", "SELECT id, county_fips, fydeclared FROM declarations")
def _(w: Workspace) -> DataFrame:
    path = scratch_dir(w.spark, "snk02")
    tables.write_plain(w.declarations(), path)
    return w.spark.read.parquet(path).select("id", "county_fips", "fydeclared")


def _version(w: Workspace, mart: str, df: DataFrame, run_dt: str = _RUN_DT, partition: str | None = None) -> str:
    return tables.write_version(df, mart, run_dt, f"{scratch_dir(w.spark, mart)}/run_dt={run_dt}", partition=partition)


@query("snk03_versioned_table", f"SELECT {_SUMMARY_COLUMNS} FROM summary")
def _(w: Workspace) -> DataFrame:
    return w.spark.table(_version(w, "hazard_event_summary_flat", w.summary()))


@query("snk04_versioned_by_year", f"SELECT {_SUMMARY_COLUMNS} FROM summary WHERE year = 1999")
def _(w: Workspace) -> DataFrame:
    return w.spark.table(_version(w, "hazard_event_summary_by_year", w.summary(), partition="year")).filter("year = 1999")


@query("snk05_idempotent_rebuild", _PER_YEAR)
def _(w: Workspace) -> DataFrame:
    path = f"{scratch_dir(w.spark, 'snk05')}/run_dt={_RUN_DT}"
    for _ in range(2):
        table = tables.write_version(w.summary(), "hazard_event_summary_twice", _RUN_DT, path)
    return _per_year(w.spark.table(table))


@query("snk07_current_view_rollback", "SELECT county_fips, year, noaa_event_count FROM mart")
def _(w: Workspace) -> DataFrame:
    mart = "risk_feature_mart_rollback"
    good = _version(w, mart, w.mart(), "2024-01-31")
    newer = _version(w, mart, w.mart().withColumn("noaa_event_count", F.lit(-1)), "2024-02-29")
    tables.promote(w.spark, mart, newer)
    tables.promote(w.spark, mart, good)
    return w.spark.table(tables.current_name(mart)).select("county_fips", "year", "noaa_event_count")


@query("snk07_current_of_another_session", "SELECT county_fips, year, noaa_event_count FROM mart")
def _(w: Workspace) -> DataFrame:
    """The version that a session without the tables of the first finds in the log, after a rollback."""
    root = scratch_dir(w.spark, "snk07-versions")
    for run_dt, rows in (("2024-01-31", w.mart()), ("2024-02-29", w.mart().withColumn("noaa_event_count", F.lit(-1).cast("bigint")))):
        path = f"{root}/run_dt={run_dt}/attempt=1"
        tables.write_partitioned(rows, path)
        commits.promote(w.spark, root, path, rows.schema, {"run_dt": run_dt})
    other = w.spark.newSession()
    if commits.current(other, root).filter("noaa_event_count <> -1").limit(1).count():
        raise AssertionError("the newest version is not the current one")
    commits.rollback(other, root, 0)
    return commits.current(w.spark, root).select("county_fips", "year", "noaa_event_count")


@query("snk09_pass_through_view", "SELECT zip5, county_fips, tot_ratio, year FROM crosswalk")
def _(w: Workspace) -> DataFrame:
    table = _version(w, "zip2county_prod", w.crosswalk())
    tables.pass_through_view(w.spark, table, "default.zip2county_dev")
    return w.spark.table("default.zip2county_dev")


@query("snk10_table_check", "SELECT 'default.county_dim__20240131' AS table_name, count(*) > 0 AS table_exists, count(*) > 0 AS ok FROM dim")
def _(w: Workspace) -> DataFrame:
    path = f"{scratch_dir(w.spark, 'snk10')}/run_dt={_RUN_DT}"
    table = tables.write_version(w.dim(), "county_dim", _RUN_DT, path, partition=None)
    return tables.check_tables(w.spark, {table: path}).drop("location")


@query(
    "snk11_csv_export",
    "SELECT county_fips, year, nri_risk_score FROM mart WHERE year = 1998 ORDER BY nri_risk_score DESC NULLS LAST, county_fips LIMIT 100",
)
def _(w: Workspace) -> DataFrame:
    path = scratch_dir(w.spark, "snk11")
    ranked = ranking.rank_counties(w.mart(), "structural", 1998, 100).select("county_fips", "year", "nri_risk_score")
    tables.export_csv(ranked, path, [F.desc_nulls_last("nri_risk_score"), F.asc("county_fips")], 100)
    return w.spark.read.schema("county_fips string, year int, nri_risk_score double").option("header", True).csv(path)


@query("snk12_partition_column_last", "SELECT zip5, county_fips, tot_ratio, year FROM crosswalk")
def _(w: Workspace) -> DataFrame:
    return tables.partition_last(w.crosswalk().select("year", "zip5", "county_fips", "tot_ratio"))


# --- columns -------------------------------------------------------------------------


@query("cn01_snake_case", "SELECT event_id, state_fips, begin_date_time FROM raw_events")
def _(w: Workspace) -> DataFrame:
    events = w.raw("events")
    wanted = ("event_id", "state_fips", "begin_date_time")
    return events.select(*[F.col(f"`{c}`").alias(names.snake_case(c)) for c in events.columns if names.snake_case(c) in wanted])


@query("cn02_normalize_columns", f"SELECT {', '.join(adapters.columns('declarations'))} FROM raw_declarations")
def _(w: Workspace) -> DataFrame:
    return names.normalize_columns(w.raw("declarations"))


@query("cn03_unique_columns", "SELECT year, begin_day AS year__dup1, event_id AS year__dup2 FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return names.make_unique_columns(w.raw("events").select("YEAR", "BEGIN_DAY", "EVENT_ID").toDF("year", "year", "year"))


@query("cn04_canonical_name", "SELECT coalesce(nullif(name, 'Lake F City, State 1'), county) AS name, state FROM raw_b01001")
def _(w: Workspace) -> DataFrame:
    rows = w.raw("b01001").select(
        F.nullif("NAME", F.lit("Lake F City, State 1")).alias("name0"), F.col("county").alias("name198"), "state"
    )
    return names.canonical_name_column(rows)


@query("cn05_coalesce_columns", "SELECT event_id, coalesce(category, cz_name, state) AS label FROM raw_events")
def _(w: Workspace) -> DataFrame:
    events = names.normalize_columns(w.raw("events"))
    return names.coalesce_columns(events, ("category", "absent", "cz_name", "state"), "label").select("event_id", "label")


@query(
    "cn06_union_safe_projection",
    "SELECT id, disasternumber, zipcode, cast(NULL AS DOUBLE) AS totaldamage FROM raw_renters",
)
def _(w: Workspace) -> DataFrame:
    wanted = {"id": "string", "disasternumber": "bigint", "zipcode": "string", "totaldamage": "double"}
    return names.project_to(names.normalize_columns(w.raw("renters")), wanted)


@query("cn07_blank_to_null", f"SELECT event_id, {blank('state')} AS state, {blank('cz_fips')} AS cz_fips FROM raw_events")
def _(w: Workspace) -> DataFrame:
    events = names.normalize_columns(w.raw("events"))
    return casts.blanks_to_null(events, ("state", "cz_fips", "absent")).select("event_id", "state", "cz_fips")


@query(
    "cn08_typed_casts",
    "SELECT event_id, try_cast(injuries_direct AS INT) AS injuries_direct, try_cast(deaths_direct AS INT) AS deaths_direct, "
    "try_cast(magnitude AS DOUBLE) AS magnitude FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    events = casts.try_casts(
        names.normalize_columns(w.raw("events")), {"int": silver.EVENT_INTS, "double": silver.EVENT_DOUBLES}
    )
    return events.select("event_id", "injuries_direct", "deaths_direct", "magnitude")


@query(
    "cn09_timestamps",
    f"SELECT event_id, {report_time('begin_date_time', 'year')} AS begin_date_time, {report_time('end_date_time', 'year')} AS end_date_time FROM "
    r"(SELECT * REPLACE (try_cast(regexp_extract(year, '(\d{4})', 1) AS INT) AS year) FROM raw_events) WHERE year IS NOT NULL",
)
def _(w: Workspace) -> DataFrame:
    events = casts.with_year(names.normalize_columns(w.raw("events"))).filter("year IS NOT NULL")
    return events.select(
        "event_id", *[casts.parse_timestamp(c, "year").alias(c) for c in ("begin_date_time", "end_date_time")]
    )


@query(
    "cn10_dates",
    "SELECT id, try_cast(substr(declarationdate, 1, 10) AS DATE) AS declarationdate, try_cast(substr(incidentbegindate, 1, 10) AS DATE) AS incidentbegindate FROM raw_declarations",
)
def _(w: Workspace) -> DataFrame:
    rows = names.normalize_columns(w.raw("declarations"))
    return casts.try_dates(rows, silver.DECLARATION_DATES).select("id", "declarationdate", "incidentbegindate")


@query("cn11_year", r"SELECT event_id, try_cast(regexp_extract(year, '(\d{4})', 1) AS INT) AS year FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return casts.with_year(names.normalize_columns(w.raw("events"))).select("event_id", "year")


@query("cn12_required_keys", "SELECT event_id, episode_id, state, cz_fips, year FROM keyed_events")
def _(w: Workspace) -> DataFrame:
    return silver.keyed_events(w.raw("events")).select("event_id", "episode_id", "state", "cz_fips", "year")


@query("cn13_literal_tags", "SELECT id, 'owner' AS tenure, 2022 AS acs_year FROM raw_owners")
def _(w: Workspace) -> DataFrame:
    return w.raw("owners").select("id", F.lit("owner").alias("tenure"), F.lit(2022).alias("acs_year"))


@query("cn14_damage_strict", f"SELECT event_id, damage_property, {strict('damage_property')} AS usd FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return w.raw("events").select(
        F.col("EVENT_ID").alias("event_id"), F.col("DAMAGE_PROPERTY").alias("damage_property"), damage.damage_usd_strict("DAMAGE_PROPERTY").alias("usd")
    )


@query("cn15_damage_lenient", f"SELECT event_id, damage_property, {lenient('damage_property')} AS usd FROM raw_events")
def _(w: Workspace) -> DataFrame:
    return w.raw("events").select(
        F.col("EVENT_ID").alias("event_id"), F.col("DAMAGE_PROPERTY").alias("damage_property"), damage.damage_usd_lenient("DAMAGE_PROPERTY").alias("usd")
    )


@query("cn16_zero_default_sums", f"SELECT event_id, {zsum('deaths_direct', 'deaths_indirect')} AS fatalities FROM events_clean")
def _(w: Workspace) -> DataFrame:
    return w.events().select("event_id", casts.zero_sum("deaths_direct", "deaths_indirect").alias("fatalities"))


@query("cn17_default_category", "SELECT event_id, coalesce(category, 'UNKNOWN') AS hazard_category FROM events_clean")
def _(w: Workspace) -> DataFrame:
    return w.events().select("event_id", casts.default_text("category").alias("hazard_category"))


# --- scalar functions ------------------------------------------------------------------


@query(
    "fn01_text_case_and_length",
    "SELECT event_id, trim(cz_type) AS trimmed, upper(cz_type) AS upper_type, lower(state) AS lower_state, length(cz_name) AS name_length FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    return w.raw("events").select(
        F.col("EVENT_ID").alias("event_id"),
        F.trim("CZ_TYPE").alias("trimmed"),
        F.upper("CZ_TYPE").alias("upper_type"),
        F.lower("STATE").alias("lower_state"),
        F.length("CZ_NAME").cast("bigint").alias("name_length"),
    )


@query(
    "fn02_pad_concat_substr",
    "SELECT event_id, lpad(cz_fips, 3, '0') AS padded, concat_ws('-', state, cz_name) AS joined, substr(damage_crops, -1) AS suffix FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    return w.raw("events").select(
        F.col("EVENT_ID").alias("event_id"),
        F.lpad("CZ_FIPS", 3, "0").alias("padded"),
        F.concat_ws("-", "STATE", "CZ_NAME").alias("joined"),
        F.substring("DAMAGE_CROPS", -1, 1).alias("suffix"),
    )


@query(
    "fn03_regular_expressions",
    r"SELECT event_id, regexp_replace(cz_name, '[^A-Za-z]', '', 'g') AS letters, regexp_extract(year, '(\d{4})', 1) AS digits, regexp_matches(cz_name, '\(C\)$') AS marked FROM raw_events",
)
def _(w: Workspace) -> DataFrame:
    return w.raw("events").select(
        F.col("EVENT_ID").alias("event_id"),
        F.regexp_replace("CZ_NAME", "[^A-Za-z]", "").alias("letters"),
        F.regexp_extract("YEAR", r"(\d{4})", 1).alias("digits"),
        F.col("CZ_NAME").rlike(r"\(C\)$").alias("marked"),
    )


@query(
    "fn04_null_handling",
    "SELECT id, coalesce(zipcode, city) AS place, nullif(validregistrations, 'x') AS registrations, CASE WHEN rentalamount IS NULL THEN 'none' ELSE 'some' END AS rental FROM raw_owners",
)
def _(w: Workspace) -> DataFrame:
    return names.normalize_columns(w.raw("owners")).select(
        "id",
        F.coalesce("zipcode", "city").alias("place"),
        F.nullif("validregistrations", F.lit("x")).alias("registrations"),
        F.when(F.col("rentalamount").isNull(), "none").otherwise("some").alias("rental"),
    )


@query(
    "fn05_casts",
    "SELECT nri_id, try_cast(risk_score AS DOUBLE) AS risk_score, cast(eal_score AS DOUBLE) AS eal_score FROM raw_nri",
)
def _(w: Workspace) -> DataFrame:
    return w.raw("nri").select(
        F.col("NRI_ID").alias("nri_id"),
        F.col("RISK_SCORE").try_cast("double").alias("risk_score"),
        F.col("EAL_SCORE").cast("double").alias("eal_score"),
    )


@query(
    "fn06_date_parts",
    "SELECT event_id, cast(year(begin_date_time) AS INT) AS begin_year, cast(end_date_time AS DATE) AS end_date FROM events_clean",
)
def _(w: Workspace) -> DataFrame:
    return w.events().select(
        "event_id", F.year("begin_date_time").alias("begin_year"), F.to_date("end_date_time").alias("end_date")
    )


@query(
    "fn07_rounding",
    "SELECT county_fips, year, round(fema_total_damage * 2 / 8, 1) AS eighth FROM mart",
)
def _(w: Workspace) -> DataFrame:
    return w.mart().select("county_fips", "year", F.round(F.col("fema_total_damage") * 2 / 8, 1).alias("eighth"))


@query("fn08_sha2", "SELECT event_id, sha256(cz_name) AS name_hash FROM raw_events WHERE cz_name IS NOT NULL")
def _(w: Workspace) -> DataFrame:
    rows = w.raw("events").filter("CZ_NAME IS NOT NULL")
    return rows.select(F.col("EVENT_ID").alias("event_id"), F.sha2("CZ_NAME", 256).alias("name_hash"))


@query(
    "fn09_text_tests",
    "SELECT zip, county, starts_with(county, '3') AS starts, ends_with(county, '0') AS ends, contains(county, '22') AS has FROM raw_crosswalk",
)
def _(w: Workspace) -> DataFrame:
    county = F.col("county")
    return w.raw("crosswalk").select(
        "zip", "county", county.startswith("3").alias("starts"), county.endswith("0").alias("ends"), county.contains("22").alias("has")
    )


@query(
    "fn10_approximate_percentile",
    "SELECT year, quantile_disc(noaa_event_count, 0.5) AS median_events FROM mart GROUP BY year",
)
def _(w: Workspace) -> DataFrame:
    return w.mart().groupBy("year").agg(F.percentile_approx("noaa_event_count", 0.5, 100000).alias("median_events"))


@query(
    "fn13_money_label",
    "SELECT county_fips, year, CASE WHEN fema_total_damage >= 1e9 THEN printf('$%.2fB', fema_total_damage / 1e9) "
    "WHEN fema_total_damage >= 1e6 THEN printf('$%.2fM', fema_total_damage / 1e6) "
    "WHEN fema_total_damage >= 1e3 THEN printf('$%.2fK', fema_total_damage / 1e3) ELSE printf('$%.0f', fema_total_damage) END AS label "
    "FROM (SELECT county_fips, year, floor(fema_total_damage / 1000) * 1000 + 7 AS fema_total_damage FROM mart)",
)
def _(w: Workspace) -> DataFrame:
    value = F.floor(F.col("fema_total_damage") / 1000) * 1000 + 7
    return w.mart().select("county_fips", "year", display.money_label(value).alias("label"))
