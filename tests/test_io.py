"""Readers, writers, versions, landing, and the whole run from files to marts."""

import gzip
import hashlib
import json
import os

import pytest
from conftest import SF, plan_of, values
from pyspark.sql import functions as F

from countyrisk import schemas
from countyrisk.catalogue import workspace
from countyrisk.config import Paths, YearWindow
from countyrisk.operators import checks
from countyrisk.operators.checks import Check, Suite
from countyrisk.plans import audits, gold, pipeline, publish, silver
from countyrisk.session import scratch_dir, scratch_root, scratch_scope
from countyrisk.sinks import tables
from countyrisk.sources import files, landing
from countyrisk.sources import pages as pages_module


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)


# --- readers ---------------------------------------------------------------------------


def test_repeated_headers_and_metadata_files(spark, tmp_path):
    put(tmp_path / "a.csv", "YEAR,Year,NAME,NAME,Begin Date\n2010,x,a,b,1\n")
    put(tmp_path / "a.csv.metadata.json", '{"rows": 1}\n')
    df = files.read_csv_text(spark, str(tmp_path), ("year", "name"))
    assert df.columns == ["year", "year__dup1", "name", "name__dup1", "begin_date"]
    assert [tuple(r) for r in df.collect()] == [("2010", "x", "a", "b", "1")]


def test_gzip_is_spread_by_measured_size(spark, tmp_path):
    put(tmp_path / "small" / "a.csv.gz", "A,B\n" + "".join(f"{i},x\n" for i in range(100)))
    assert "Exchange" not in plan_of(files.read_csv_gz(spark, str(tmp_path / "small")))
    # one file with most of the bytes beside small ones
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", "2k")
    for k in range(9):
        put(tmp_path / "skewed" / f"{k}.csv.gz", "A,B\n" + "".join(f"{i},{hash((k, i))}\n" for i in range(5_000 if k == 0 else 50)))
    df = files.read_csv_gz(own, str(tmp_path / "skewed"))
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 5_400 and len(sizes) >= 8 and max(sizes) < 1.2 * min(sizes)
    for k in range(8):
        put(tmp_path / "even" / f"{k}.csv.gz", "A,B\n" + "".join(f"{i},{hash((k, i))}\n" for i in range(500)))
    assert "Exchange" not in plan_of(files.read_csv_gz(own, str(tmp_path / "even")))
    assert files.setting_bytes(own, "spark.sql.files.openCostInBytes") == 2048
    assert files.setting_bytes(spark, "spark.sql.files.maxPartitionBytes") == 128 << 20


def test_columns_are_found_by_name(spark, tmp_path):
    put(tmp_path / "x.csv", "county,zip,USPS City,tot_ratio,year,top_match\n01001,36067,PRATTVILLE,0.5,2012,True\n")
    assert files.read_crosswalk(spark, str(tmp_path)).first().asDict() == {
        "zip": "36067", "county": "01001", "year": "2012", "tot_ratio": "0.5", "top_match": "True"
    }
    put(tmp_path / "n" / "n.csv", "OBJECTID,NRI_ID,STATE,STATEFIPS,COUNTY,COUNTYFIPS,STCOFIPS,RISK_SCORE,EAL_SCORE,SOVI_SCORE,RESL_SCORE,WNTW_RISKR,Shape__Area\n"
        "1,C01001,Alabama,1,Autauga,1,01001,58.0,60,51,49,Low,2.5\n")
    row = files.read_bronze(spark, str(tmp_path / "n"), "nri_counties").first()
    assert (row.nri_id, row.state, row.stcofips, row.resl_score, row.wntw_riskr, row.shape_area, row.hail_evnts) == ("C01001", "Alabama", 1001, 49.0, "Low", 2.5, None)
    put(tmp_path / "m" / "m.csv", "zip,county,year\n1,2,3\n")
    with pytest.raises(ValueError, match="top_match, tot_ratio"):
        files.read_crosswalk(spark, str(tmp_path / "m"))


def test_typed_reader_keeps_corrupt_rows_apart(spark, tmp_path):
    put(tmp_path / "m.csv", 'event_type,hazard_group,hazard_subgroup\n"Hail, large",Storm,"a \\"b\\""\n')
    row = files.read_csv_typed(spark, str(tmp_path), schemas.HAZARD_TYPE_MAP).first()
    assert tuple(row) == ("Hail, large", "Storm", 'a "b"')
    put(tmp_path / "c" / "c.csv", "state,name,b19013_001e,county\n1,A,x,1\n1,B,5,3\n")
    df = files.read_csv_typed(spark, str(tmp_path / "c"), schemas.ACS_TABLES["b19013"], keep_corrupt=True).cache()
    assert [tuple(r) for r in df.orderBy("name").collect()] == [("A", None, 1, 1, '{"name":"A","b19013_001e":"x","state":"1","county":"1"}'), ("B", 5, 1, 3, None)]
    with pytest.raises(ValueError):
        files.read_bronze(spark, str(tmp_path), "other")


def test_json_pages_and_header_arrays(spark, tmp_path):
    page = {"features": [{"attributes": {"NRI_ID": "a", "RISK_SCORE": 1.5}}, {"attributes": {"NRI_ID": "b"}}], "exceededTransferLimit": False}
    put(tmp_path / "p" / "1.json", json.dumps(page, indent=1))
    df = files.read_feature_pages(spark, str(tmp_path / "p"), "NRI_ID string, RISK_SCORE double")
    assert sorted(map(tuple, df.collect()), key=str) == [("a", 1.5), ("b", None)]
    put(tmp_path / "h" / "1.json", json.dumps([["NAME", "state"], ["A", "01"], ["B", None]]))
    put(tmp_path / "h" / "2.json", json.dumps([["NAME", "state"]]))
    df = files.read_header_arrays(spark, str(tmp_path / "h"), ["name", "STATE", "absent"])
    assert df.columns == ["name", "state", "absent"]
    assert sorted(map(tuple, df.collect()), key=str) == [("A", "01", None), ("B", None, None)]


def test_bronze_schemas_have_the_declared_widths():
    widths = {name: len(schema) for name, schema in schemas.BRONZE.items()}
    assert widths["disaster_declarations"] == 28
    assert widths["housing_assistance_owners"] == 24 and widths["housing_assistance_renters"] == 21
    assert "totaldamage" not in schemas.RENTERS.names
    assert widths["nri_counties"] == 467
    assert widths["acs5_2022_b01001"] == 1 + 49 * 4 + 3


# --- landing ------------------------------------------------------------------------------


def test_manifest_skip_and_sizes(spark, tmp_path):
    put(tmp_path / "d" / "a.csv", "x\n1\n2\n")
    put(tmp_path / "d" / "b.csv", "")
    put(tmp_path / "d" / "a.csv.metadata.json", "{}")
    manifest = landing.landing_manifest(spark, str(tmp_path / "d"), "2024-01-31")
    got = {r["name"]: (r["bytes"], r["row_count"], r["status"], len(r["sha256"])) for r in manifest.collect()}
    assert got == {"a.csv": (6, 2, "OK", 64), "b.csv": (0, 0, "EMPTY", 64)}
    listing = spark.createDataFrame([("a.csv", 6), ("a.csv", 7), ("c.csv", 1)], "name string, bytes bigint")
    assert sorted(map(tuple, landing.not_landed(listing, manifest).collect())) == [("a.csv", 7), ("c.csv", 1)]
    expected = spark.createDataFrame([("a.csv",), ("b.csv",), ("z.csv",)], "name string")
    checked = {r["name"]: tuple(r)[1:] for r in landing.presence_checks(manifest, expected, 3).collect()}
    assert checked == {"a.csv": (False, False, True), "b.csv": (False, True, True), "z.csv": (True, False, False)}
    assert landing.is_ready(manifest.filter("false")).first().ready is False


def test_files_are_hashed_in_chunks(spark, tmp_path):
    put(tmp_path / "d" / "a.csv", "x\n" + "1\n" * 3000)
    put(tmp_path / "d" / "b.csv.gz", "x\n2\n")
    put(tmp_path / "d" / "c.csv", "")
    wanted = {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / "d").iterdir()}
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 16)  # what a row may hold of a file
    try:
        manifest = landing.landing_manifest(spark, str(tmp_path / "d"), "2024-01-31")
        assert {r["name"]: r["sha256"] for r in manifest.collect()} == wanted
        named = landing.hashes_of(spark, [str(tmp_path / "d" / n) for n in wanted])
        assert {os.path.basename(r["path"]): r["sha256"] for r in named.collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_latest_file_and_year_scope(spark):
    names = [f"StormEvents_details-ftp_v1.0_d2000_c{d}.csv.gz" for d in ("20240101", "20250520", "20230909")]
    listing = spark.createDataFrame([(n,) for n in [*names, "readme.txt"]], "name string")
    assert [tuple(r) for r in landing.latest_files(listing).collect()] == [("details", 2000, names[1], "20250520")]
    scope = lambda *a: values(landing.year_scope(spark, *a), "year")
    assert scope("backfill", "2024-01-31", 2000, 2002) == [2000, 2001, 2002]
    assert scope("monthly", "2024-01-31", 2000, 2002, -1) == [2023]
    with pytest.raises(ValueError):
        scope("backfill", "2024-01-31", 2002, 2000)


# --- sinks -----------------------------------------------------------------------------------


def test_scratch_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_empty_table_and_drops(spark, tmp_path):
    table = tables.create_empty_table(spark, "county_risk_scores", schemas.COUNTY_RISK_SCORES, str(tmp_path / "s"))
    assert spark.table(table).count() == 0 and spark.table(table).columns == schemas.COUNTY_RISK_SCORES.names
    assert gold.county_risk_scores(spark).schema == schemas.COUNTY_RISK_SCORES
    tables.drop_tables(spark, ["county_risk_scores", "never_there"])
    assert not spark.catalog.tableExists(table)
    with pytest.raises(RuntimeError):
        tables.check_tables(spark, {table: None})
    assert tables.check_tables(spark, {table: None}, hard_fail=False).first().ok is False


def test_publish_blocks_promotes_and_rolls_back(spark, tmp_path):
    def version(rows, run_dt, **options):
        df = spark.createDataFrame(rows, "county_fips string, year int")
        suite = lambda t: Suite("m", t, [Check("nulls", checks.any_null(["county_fips"]))])
        return publish.publish_version(df, "hazard_event_summary", run_dt, str(tmp_path / run_dt), suite, **options)

    view = tables.current_name("hazard_event_summary")
    first = version([("01001", 2010)], "2024-01-31")
    assert first.promoted and first.status == "pass" and spark.table(view).count() == 1
    bad = version([(None, 2010)], "2024-02-29")
    assert bad.blocked and not bad.promoted and values(spark.table(view), "county_fips") == ["01001"]
    with pytest.raises(publish.BlockedError):
        version([(None, 2010)], "2024-02-29", raise_on_block=True)
    again = version([("01003", 2011), ("01005", 2012)], "2024-02-29")
    assert again.promoted and spark.table(view).count() == 2 and spark.table(again.table).columns[-1] == "year"
    tables.promote(spark, "hazard_event_summary", first.table)
    assert values(spark.table(view), "county_fips") == ["01001"]
    with pytest.raises(ValueError):
        publish.publish_version(spark.range(1).toDF("year"), "other", "2024-01-31", str(tmp_path / "o"))


def test_run_log_blocks_the_next_layer(spark, tmp_path):
    path = str(tmp_path / "log")
    add = lambda status, block: publish.append_log(
        publish.log_entry(spark, "r1", "2024-01-31", "silver", "quality", "events", {"n": 1}, status, block), path
    )
    add("fail", True)
    log = publish.read_log(spark, path)
    assert values(publish.blocking_reports(log, "silver"), "name") == ["events"]
    with pytest.raises(publish.BlockedError):
        publish.require_unblocked(log, "silver", "2024-01-31")
    publish.require_unblocked(log, "bronze")
    add("pass", False)
    publish.require_unblocked(publish.read_log(spark, path), "silver", "2024-01-31")


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_pages_are_read_piecewise(spark, tmp_path, chunk):
    odd = {"a": "]}{[,\"\\ é日𝔘", "n": [1.5e3, None, {"features": [9]}], "t": True}
    pages = {
        "one.json": json.dumps({"first": {"features": [1]}, "features": [odd, 12, -3, "x", [], {}], "last": [1]}, ensure_ascii=False, indent=1),
        "two.json": '\ufeff{"features" : [ ] }',
        "none.json": '{"other": [1, 2]}',
        "text.json": '"features"',
        "blank.json": " \n",
        "no_array.json": '{"features": 3}',
    }
    for name, text in pages.items():
        put(tmp_path / "p" / "deep" / name, text)
    found = pages_module.page_elements(spark, str(tmp_path / "p"), "features", chunk).orderBy("place").collect()
    assert [json.loads(r.value) for r in found] == [odd, 12, -3, "x", [], {}] and {r.path.rsplit("/", 1)[1] for r in found} == {"one.json"}
    put(tmp_path / "a" / "rows.json", '[["A","b"],["1",null],["2","x"]]')
    rows = pages_module.page_elements(spark, str(tmp_path / "a"), None, chunk).orderBy("place").collect()
    assert [(r.place, r.head, json.loads(r.value)) for r in rows][1:] == [(1, '["A","b"]', ["1", None]), (2, '["A","b"]', ["2", "x"])]
    for text in ('{"features": [1, 2', '{"features": [1 2]}', '{"features": [{"a": }]}', '{"features" [1]}'):
        with pytest.raises(ValueError):
            list(pages_module.elements(iter([text[k : k + chunk].encode() for k in range(0, len(text), chunk)]), "features"))


def test_a_page_is_never_held_whole():
    feature = json.dumps({"attributes": {"NRI_ID": "x" * 200}}).encode() + b","
    chunk, read = feature * 500, 0

    def chunks():
        nonlocal read
        yield b'{"features": ['
        for _ in range(200):
            read += 1
            yield chunk
        yield b"{}]}"

    most = 0
    for count, _ in enumerate(pages_module.elements(chunks(), "features"), 1):
        most = max(most, read - count // 500)
    assert count == 100_001 and most <= 2


def test_scratch_folders_go_with_their_scope(spark):
    kept = scratch_dir(spark, "kept")
    with scratch_scope(spark):
        outer = scratch_dir(spark, "outer")
        spark.range(3).write.mode("overwrite").parquet(outer)
        with pytest.raises(KeyError), scratch_scope(spark):
            inner = scratch_dir(spark, "inner")
            raise KeyError
        assert not os.path.exists(inner) and spark.read.parquet(outer).count() == 3
    assert not os.path.exists(outer) and os.path.exists(kept)


def test_listing_by_tasks(spark, tmp_path):
    for name in ("top.csv", "a/b/deep.csv.gz", "a/empty.csv", "a/note.txt", "_tmp/x.csv", "c d/s p.csv", "a/_part/y.csv", "c d/.hidden.csv"):
        path = tmp_path / "land" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("" if "empty" in name else "A\n1\n")
    found = landing.list_files(spark, str(tmp_path / "land"), "{*.csv,*.csv.gz}")
    assert sorted((r.name, r.bytes) for r in found.collect()) == [("deep.csv.gz", 4), ("empty.csv", 0), ("s p.csv", 4), ("top.csv", 4)]
    assert all((tmp_path / "land").as_posix() in r.path and open(r.path).read() in ("", "A\n1\n") for r in found.collect())
    # a partition for each folder of the first level and one for the files beside them
    assert landing.listed(spark, str(tmp_path / "land")).rdd.getNumPartitions() == 3
    assert landing.is_ready(found).first().ready and not landing.is_ready(landing.list_files(spark, str(tmp_path / "none"))).first().ready
    same = landing.list_files(spark, f"file://{tmp_path}/land", "?op.csv").collect()
    assert [(r.name, r.path) for r in same] == [("top.csv", f"{tmp_path}/land/top.csv")]
    assert not landing.can_list("viewfs://store/in")


# --- the whole run --------------------------------------------------------------------------------


EVENT_HEADER = (
    "EVENT_ID,EPISODE_ID,STATE,STATE_FIPS,CZ_TYPE,CZ_FIPS,CZ_NAME,EVENT_TYPE,CATEGORY,YEAR,Year,BEGIN_DATE_TIME,END_DATE_TIME,"
    "INJURIES_DIRECT,INJURIES_INDIRECT,DEATHS_DIRECT,DEATHS_INDIRECT,DAMAGE_PROPERTY,DAMAGE_CROPS\n"
)


def _raw_files(root):
    when = "28-APR-12 14:45:00,28-APR-12 15:45:00"
    put(
        root / "bronze/noaa/details/d2012.csv.gz",
        EVENT_HEADER
        + f"1,1,ALABAMA,1,C,1,AUTAUGA,Hail,,2012,2012,{when},1,0,0,0,10K,0\n"
        + f"1,1,ALABAMA,1,C,1,AUTAUGA,Hail,,2012,2012,{when},1,0,0,0,10K,0\n"
        + f"2,1,ALABAMA,1,C,999,Baldwin,Tornado,,2012,2012,{when},0,2,1,0,2M,0\n"
        + f"3,1,ALABAMA,1,Z,1,ZONE,Hail,,2012,2012,{when},0,0,0,0,,0\n"
        + f"4,1,ALABAMA,1,C,998,NOWHERE,Hail,,2012,2012,{when},0,0,0,0,,0\n"
        + f"5,1,,1,C,1,AUTAUGA,Hail,,2012,2012,{when},0,0,0,0,,0\n",
    )
    put(root / "bronze/noaa/details/d2012.csv.gz.metadata.json", "{}")
    put(
        root / "bronze/fema/disaster_declarations/a.csv",
        "disasterNumber,state,fyDeclared,fipsStateCode,fipsCountyCode,incidentType,declarationType,declarationDate,id\n"
        "100,AL,2012,01,001,Storm,DR,2012-04-30T00:00:00.000Z,x\n100,AL,2012,01,003,Storm,DR,2012-04-30T00:00:00.000Z,y\n",
    )
    common = "disasterNumber,state,county,city,zipCode,validRegistrations,totalInspected,approvedForFemaAssistance,totalApprovedIhpAmount,repairReplaceAmount,rentalAmount,otherNeedsAmount,id"
    put(root / "bronze/fema/housing_assistance_owners/a.csv", common + ",totalDamage\n100,AL,Autauga,P,36003,10,5,4,100,50,20,10,o1,1000\n")
    put(root / "bronze/fema/housing_assistance_renters/a.csv", common + "\n100,AL,Autauga,P,36003,6,3,2,60,30,10,5,r1\n")
    put(
        root / "bronze/nri/counties/a.csv",
        "NRI_ID,STATE,STATEFIPS,COUNTY,COUNTYFIPS,STCOFIPS,RISK_SCORE,EAL_SCORE,SOVI_SCORE,RESL_SCORE\n"
        "C1,Alabama,1,Autauga,1,1001,50.5,1,2,3\nC2,Alabama,1,Baldwin,3,1003,,1,2,3\nC3,Alabama,1,Bad,0,,1,1,2,3\n",
    )
    cells = {"B01001": ["B01001_001E"], "B19013": ["B19013_001E"], "B25077": ["B25077_001E"]}
    cells["B23025"] = ["B23025_001E", "B23025_002E", "B23025_005E"]
    cells["B15003"] = ["B15003_001E", "B15003_017E", "B15003_022E", "B15003_025E"]
    for table, columns in cells.items():
        put(
            root / f"bronze/census/acs5_2022_{table}/a.csv",
            ",".join(["NAME", *columns, "NAME", "state", "county"])
            + "\n"
            + "".join(f'"{n} County, Alabama",{",".join(["7"] * len(columns))},x,1,{c}\n' for n, c in (("Autauga", 1), ("Baldwin", 3))),
        )
    put(
        root / "bronze/reference/zip2county_master_xwalk/a.csv",
        "zip,county,year,tot_ratio,top_match\n36003,1001,2012,0.75,True\n36003,1003,2012,0.25,False\n",
    )


def test_run_from_files_to_current_views(spark, tmp_path):
    _raw_files(tmp_path)
    paths = Paths(str(tmp_path))
    for _ in range(2):  # a second run of the same date replaces the first
        status = pipeline.run_pipeline(spark, paths, "run-1", "2024-01-31", YearWindow())
    assert status == "pass"
    events = spark.read.parquet(pipeline.events_path(paths.silver("noaa_events")))
    assert {(r.event_id, r.county_fips, r.county_fips_mapping_method) for r in events.collect()} == {
        ("1", "01001", "direct_code"),
        ("2", "01003", "name_match"),
    }
    for outcome, event in (("unresolved", "4"), ("non_county", "3")):
        assert values(spark.read.parquet(pipeline.events_path(paths.silver("noaa_events"), outcome)), "event_id") == [event]
    assert spark.table("default.noaa_events_clean_unresolved_county_fips").count() == 1
    assert spark.table("default.fema_claims_clean").columns == list(schemas.CLAIMS)
    mart = {r.county_fips: r for r in spark.table("default.risk_feature_mart_current").collect()}
    assert set(mart) == {"01001", "01003"}
    row = mart["01001"]
    assert (row.noaa_event_count, row.noaa_avg_property_damage, row.noaa_total_injuries) == (1, 10000.0, 1)
    assert (row.fema_valid_registrations, row.fema_total_damage, row.fema_declaration_count) == (12.0, 750.0, 1)
    assert (row.population_total, row.nri_risk_score, row.census_acs_year, row.year) == (7, 50.5, 2022, 2012)
    assert mart["01003"].nri_risk_score is None and mart["01003"].fema_total_damage == 0.0
    summary = spark.table("default.hazard_event_summary_current")
    assert sorted(values(summary, "hazard_category")) == ["UNKNOWN", "UNKNOWN"]
    log = publish.read_log(spark, paths.ops("run_log"))
    assert set(values(log, "kind")) == {"plan", "quality", "metadata", "health", "summary"}
    metrics = json.loads(log.filter("name = 'row_counts'").first().payload)
    assert metrics["events"]["valid_rows"] == 2 and metrics["events"]["unresolved_rows"] == 1
    scores = spark.read.parquet(paths.silver("nri_scores_clean"))
    reasons = audits.null_summary(spark.table("default.risk_feature_mart_current"), scores).collect()
    assert [(r.nri_join_status, r.feature_presence, r.rows) for r in reasons] == [("present_in_nri_but_score_null", "noaa_only", 1)]
    type_map = spark.createDataFrame([("Hail", "Storm", "x")], "event_type string, hazard_group string, hazard_subgroup string")
    built = pipeline.build_scaffold(spark, paths, "2024-01-31", type_map)
    assert built.results.count() == 13 and built.promoted == (not built.blocked)
    universe = spark.read.parquet(paths.gold("county_year_universe", "2024-01-31"))
    assert spark.table(built.table).count() == universe.count() > 0
    # another session, from the commit logs alone
    other = spark.newSession()
    assert len(pipeline.open_current(other, paths)) >= 2
    assert {r.county_fips for r in other.table("risk_feature_mart_current").collect()} == {"01001", "01003"}


def test_incremental_run_of_the_pipeline(spark, tmp_path):
    _raw_files(tmp_path)
    paths = Paths(str(tmp_path))
    scope = pipeline.Landing("backfill", 2000, 2030)
    details = tmp_path / "bronze/noaa/details"
    (details / "d2012.csv.gz").rename(details / "StormEvents_details-ftp_v1.0_d2012_c20240101.csv.gz")
    mart = lambda: {(r.county_fips, r.year): r.noaa_event_count for r in spark.table("default.risk_feature_mart_current").collect()}
    assert pipeline.run_pipeline(spark, paths, "run-1", "2024-01-31", scope=scope) == "pass"
    assert mart() == {("01001", 2012): 1, ("01003", 2012): 1}
    when = "28-APR-13 14:45:00,28-APR-13 15:45:00"
    put(
        details / "StormEvents_details-ftp_v1.0_d2013_c20240201.csv.gz",
        EVENT_HEADER + f"21,1,ALABAMA,1,C,1,AUTAUGA,Hail,,2013,2013,{when},1,0,0,0,10K,0\n",
    )
    assert pipeline.run_pipeline(spark, paths, "run-2", "2024-02-29", scope=scope) == "pass"
    assert mart() == {("01001", 2012): 1, ("01003", 2012): 1, ("01001", 2013): 1}
    logged = [json.loads(r.payload)["events"]["years"] for r in publish.read_log(spark, paths.ops("run_log")).filter("name = 'row_counts'").orderBy("logged_at").collect()]
    assert logged == [[2012], [2013]]
    assert spark.table("noaa_events_clean_unresolved_county_fips").count() == 1
    for name in pipeline.EVENT_TABLES.values():
        spark.catalog.dropTempView(name)


def test_missing_key_sources_are_errors(spark):
    with pytest.raises(ValueError):
        silver.clean_scores(spark.range(1).toDF("x"))
    with pytest.raises(ValueError):
        silver.keyed_events(spark.range(1).select(F.lit("1").alias("EVENT_ID")))


def test_parquet_is_dealt_anew_only_if_its_tasks_are_uneven(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        rows = spark.range(100_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1)
        for name, size in (("many", "262144"), ("one", str(1 << 30))):
            rows.write.option("parquet.block.size", size).option("parquet.block.size.row.check.min", "100").parquet(str(tmp_path / name))
            df = spark.read.parquet(str(tmp_path / name))
            found = files.spread_parquet(df, str(tmp_path / name))
            assert ("RoundRobin" in plan_of(found)) == (name == "one")
            assert found.exceptAll(rows).isEmpty() and found.count() == 100_000
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_split_size_holds_for_the_jobs_inside(spark, tmp_path):
    path, name = str(tmp_path / "rows"), "spark.sql.files.maxPartitionBytes"
    spark.range(400_000).coalesce(1).write.option("parquet.block.size", 256 << 10).parquet(path)
    rows, before = spark.read.parquet(path), spark.conf.get(name)
    with files.split_size(spark, "512KB"):
        inside = rows.groupBy(F.spark_partition_id()).count().collect()
        with files.split_size(spark, "1GB"):
            assert spark.conf.get(name) == "512KB"  # never larger
    assert len(inside) >= 3 and sum(r[1] for r in inside) == 400_000
    with pytest.raises(ZeroDivisionError), files.split_size(spark, "512KB"):
        1 / 0
    assert spark.conf.get(name) == before


def test_cleaning_reads_raw_rows_in_small_splits(spark):
    seen, w = [], workspace.Workspace(spark, SF)

    def build():
        seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        return w.raw("nri")

    w._clean("probe", build)
    w.raw = lambda _, raw=w.raw: seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes")) or raw(_)
    w.events()
    assert set(seen) == {workspace.RAW_SPLIT}
