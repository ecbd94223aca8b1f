"""Commit logs and the incremental run, against full runs over the same files."""

import gzip
import os
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import values
from pyspark.sql import functions as F

from countyrisk.catalogue import marts  # noqa: F401 (it registers)
from countyrisk.catalogue.registry import QUERIES
from countyrisk.operators import dedupe, resolve
from countyrisk.plans import incremental, profiles, silver
from countyrisk.sinks import commits, storage, tables
from countyrisk.sources import files, landing

HEADER = (
    "EVENT_ID,EPISODE_ID,STATE,STATE_FIPS,CZ_TYPE,CZ_FIPS,CZ_NAME,EVENT_TYPE,CATEGORY,YEAR,Year,BEGIN_DATE_TIME,END_DATE_TIME,"
    "INJURIES_DIRECT,INJURIES_INDIRECT,DEATHS_DIRECT,DEATHS_INDIRECT,DAMAGE_PROPERTY,DAMAGE_CROPS\n"
)


def report(event, year, kind="C", zone=1, name="AUTAUGA", injuries=1):
    when = f"28-APR-{year % 100} 14:45:00"
    return f"{event},1,ALABAMA,1,{kind},{zone},{name},Hail,,{year},{year},{when},{when},{injuries},0,0,0,10K,0\n"


def land(folder, year, stamp, *rows, name=None):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or f"StormEvents_details-ftp_v1.0_d{year}_c{stamp}.csv.gz")
    path.write_bytes(gzip.compress((HEADER + "".join(rows)).encode()))
    return path


@pytest.fixture()
def counties(spark):
    raw = spark.createDataFrame(
        [("1", "Autauga", "1", "1001"), ("1", "Baldwin", "3", "1003")], "statefips string, county string, countyfips string, stcofips string"
    )
    return silver.county_reference(raw)


def full(spark, landed, counties):
    """A full run over the files that count."""
    paths = [r.path for r in incremental.active_files(spark, str(landed)).select("path").collect()]
    return resolve.with_outcome(silver.clean_events(files.read_csv_text(spark, paths, ("year",)), counties))


def same_rows(one, two):
    assert sorted(one.columns) == sorted(two.columns)
    two = two.select(*one.columns)
    return one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def folders_of(update, year):
    return {f for f in update.commit.folders if f.endswith(f"year={year}")}


def test_one_new_file_rewrites_one_year(spark, tmp_path, counties):
    landed, root = tmp_path / "land ed", str(tmp_path / "table")
    for year in (2010, 2011, 2012):
        land(landed, year, "20240101", report(year, year), report(year + 5000, year, "Z"), report(year + 9000, year, zone=999, name="NOWHERE"))
    (landed / "a.csv.gz.metadata.json").write_text("{}")
    first = incremental.update_events(spark, str(landed), root, counties, "r1")
    assert first.years == (2010, 2011, 2012) and len(first.changed) == len(first.read) == 3
    assert same_rows(commits.current(spark, root), full(spark, landed, counties))

    nothing = incremental.update_events(spark, str(landed), root, counties, "r2")
    assert nothing.years == () and nothing.commit.number == first.commit.number

    land(landed, 2011, "20240201", report(2011, 2011, injuries=7), report(7011, 2011, zone=3, name="BALDWIN"))
    second = incremental.update_events(spark, str(landed), root, counties, "r3")
    assert second.years == (2011,) and [Path(p).name[-21:] for p in second.read] == ["2011_c20240201.csv.gz"]
    for year in (2010, 2012):
        assert folders_of(first, year) == folders_of(second, year) != set()
    assert folders_of(first, 2011).isdisjoint(folders_of(second, 2011))
    # outcomes that 2011 has no more are gone, too
    assert {f.split("/")[1] for f in folders_of(second, 2011)} == {"outcome=valid"}
    assert same_rows(commits.current(spark, root), full(spark, landed, counties))
    assert sorted(values(incremental.events(spark, root).filter("year = 2011"), "injuries_direct")) == [1, 7]
    # the version before is whole still
    earlier = commits.read(spark, root, commits.commit_at(spark, root, first.commit.number))
    assert earlier.filter("year = 2011").count() == 3


def test_keys_of_several_years_and_files_that_go(spark, tmp_path, counties):
    landed, root = tmp_path / "landed", str(tmp_path / "table")
    land(landed, 2010, "20240101", report(1, 2010, injuries=5), report(2, 2010))
    land(landed, 2011, "20240101", report(3, 2011), report(4, 2011))
    land(landed, 2012, "20240101", report(5, 2012))
    incremental.update_events(spark, str(landed), root, counties, "r1")
    # event 1 again in 2011, with fewer injuries: one of the two rows wins, in one of the years
    late = land(landed, 2011, "20240301", report(1, 2011, injuries=0), report(3, 2011))
    second = incremental.update_events(spark, str(landed), root, counties, "r2")
    assert second.years == (2010, 2011)
    assert same_rows(commits.current(spark, root), full(spark, landed, counties))
    # 2010 changes while event 1 competes with 2011, which is only read
    land(landed, 2010, "20240401", report(1, 2010, injuries=5), report(2, 2010), report(6, 2010))
    third = incremental.update_events(spark, str(landed), root, counties, "r3")
    assert set(third.years) <= {2010, 2011} and same_rows(commits.current(spark, root), full(spark, landed, counties))
    late.unlink()
    incremental.update_events(spark, str(landed), root, counties, "r4")
    assert same_rows(commits.current(spark, root), full(spark, landed, counties))
    # a file without a date in its name, changed in place
    other = land(landed, 0, "", report(70, 2012), name="extra.csv.gz")
    incremental.update_events(spark, str(landed), root, counties, "r5")
    other.write_bytes(gzip.compress((HEADER + report(71, 2010) + report(72, 2012)).encode()))
    os.utime(other, (1, 1))
    sixth = incremental.update_events(spark, str(landed), root, counties, "r6")
    assert sixth.years == (2010, 2012) and same_rows(commits.current(spark, root), full(spark, landed, counties))
    for file in landed.glob("*_d2012_*"):
        file.unlink()
    other.unlink()
    last = incremental.update_events(spark, str(landed), root, counties, "r7")
    assert folders_of(last, 2012) == set() and same_rows(commits.current(spark, root), full(spark, landed, counties))


def test_monthly_scope_and_new_reference(spark, tmp_path, counties):
    landed, root = tmp_path / "landed", str(tmp_path / "table")
    for year in (2011, 2012):
        land(landed, year, "20240101", report(year, year), report(year + 100, year, zone=77, name="ELSEWHERE"))
    incremental.update_events(spark, str(landed), root, counties, "r1")
    for year in (2011, 2012):
        land(landed, year, "20240201", report(year + 1000, year))
    scope = landing.year_scope(spark, "monthly", "2013-01-31", 0, 0, -1)
    monthly = incremental.update_events(spark, str(landed), root, counties, "r2", scope)
    assert monthly.years == (2012,)
    assert sorted(values(incremental.events(spark, root), "event_id")) == ["2011", "3012"]
    rest = incremental.update_events(spark, str(landed), root, counties, "r3")
    assert rest.years == (2011,) and same_rows(commits.current(spark, root), full(spark, landed, counties))
    more = counties.unionByName(counties.limit(1).withColumns({"county_fips": F.lit("01077"), "county_name_norm": F.lit("ELSEWHERE"), "county_name_compact": F.lit("ELSEWHERE")}))
    land(landed, 2011, "20240301", report(2011, 2011, zone=77, name="ELSEWHERE"))
    again = incremental.update_events(spark, str(landed), root, more, "r4")
    assert again.years == (2011, 2012) and same_rows(commits.current(spark, root), full(spark, landed, more))


def test_versions_outlive_the_session_and_roll_back(spark, tmp_path):
    root = str(tmp_path / "mart")
    assert commits.latest(spark, root) is None
    with pytest.raises(LookupError):
        commits.current(spark, root)
    for n in (1, 2):
        df = spark.createDataFrame([("01001", n, 2010)], "county_fips string, n int, year int")
        df.write.partitionBy("year").parquet(f"{root}/run_dt=2024-0{n}-01/attempt=a{n}")
        commits.promote(spark, root, f"{root}/run_dt=2024-0{n}-01/attempt=a{n}", df.schema, {"run_dt": f"2024-0{n}-01"})
    other = spark.newSession()
    assert [tuple(r) for r in commits.current(other, root).collect()] == [("01001", 2, 2010)]
    commits.rollback(spark, root, 0)
    assert values(commits.current(other, root), "n") == [1]
    assert [commits.commit_at(spark, root, k).action for k in commits.history(spark, root)] == ["promote", "promote", "rollback"]
    assert values(other.table(commits.attach(other, root, "mart_now")), "n") == [1]


def test_two_writers_leave_one_winner(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = spark.range(0).schema

    def write(k, expected):
        try:
            return commits.commit(spark, root, lambda now: commits.Commit("replace", "data", (str(k),), schema.json(), {}), expected)
        except commits.ConflictError:
            return None

    with ThreadPoolExecutor(8) as pool:
        strict = list(pool.map(lambda k: write(k, -1), range(8)))
        assert sum(c is not None for c in strict) == 1 and commits.history(spark, root) == [0]
        free = list(pool.map(lambda k: write(k, None), range(8)))
    assert sorted(c.number for c in free) == list(range(1, 9)) == commits.history(spark, root)[1:]
    assert commits.latest(spark, root).folders == next(c.folders for c in free if c.number == 8)
    assert not [n for n in storage.names(spark, f"{root}/{commits.LOG}") if n.startswith(".") and not n.endswith(".crc")]


def test_profiles_are_merged_over_versions(spark, tmp_path):
    root, store = str(tmp_path / "t"), str(tmp_path / "profiles")
    rows = spark.range(1_000).selectExpr("id % 3 + 2010 AS year", "if(id % 10 = 0, NULL, id % 200) AS n", "concat('c', id % 50) AS c")
    assert profiles.update_profiles(spark, root, store, ["n"]) == [] and profiles.table_profile(spark, root, store).count() == 0

    def put(df):
        folders = commits.stage(df, root, ("year",))
        years = {commits.partition_of(f)["year"] for f in folders}
        commits.commit(spark, root, lambda now: commits.replaced(now, folders, lambda part: part["year"] in years, df.schema, {}))
        return profiles.update_profiles(spark, root, store, ["year", "n", "c"])

    assert len(put(rows)) == 3 and len(put(rows.filter("year = 2011").withColumn("n", F.lit(9_000).cast("long")))) == 1
    assert profiles.update_profiles(spark, root, store, ["year", "n", "c"]) == []
    now = commits.current(spark, root)
    found = {r.name: r for r in profiles.table_profile(spark, root, store).collect()}
    for name in ("year", "n", "c"):
        want = now.agg(F.count("*"), F.count_if(F.col(name).isNull()), F.count_distinct(name), F.min(name), F.max(name)).first()
        r = found[name]
        assert (r.rows, r.nulls) == (want[0], want[1]) and abs(r.distinct_values - want[2]) <= 0.03 * want[2]
        assert (r.low, r.high) == ((want[3], want[4]) if name == "c" else (str(float(want[3])), str(float(want[4]))))
    # figures of one folder only after a rollback to it
    commits.rollback(spark, root, 0)
    assert {r.name: r.high for r in profiles.table_profile(spark, root, store).collect()}["n"] == "199.0"


def test_a_run_reads_a_file_only_for_rows_it_holds(spark, tmp_path, counties, monkeypatch):
    landed, root = tmp_path / "landed", str(tmp_path / "table")
    land(landed, 2010, "20240101", report(1, 2010), report(2, 2010))
    incremental.update_events(spark, str(landed), root, counties, "r1")
    land(landed, 2011, "20240101", report(2, 2011), report(3, 2011, zone=3, name="BALDWIN"), report(4, 2012), report(5, 2012))
    land(landed, 2013, "20240101", report(6, 2013))
    asked, read = [], incremental.read_files
    monkeypatch.setattr(incremental, "read_files", lambda s, paths: (asked.append([Path(p).name[-21:-17] for p in paths]), read(s, paths))[1])
    incremental.update_events(spark, str(landed), root, counties, "r2")
    assert same_rows(commits.current(spark, root), full(spark, landed, counties))
    asked.clear()
    land(landed, 2013, "20240201", report(6, 2013), report(1, 2013))
    land(landed, 2014, "20240101", report(7, 2014))
    again = incremental.update_events(spark, str(landed), root, counties, "r3")
    assert again.years == (2010, 2013, 2014) and same_rows(commits.current(spark, root), full(spark, landed, counties))
    assert asked[1:] == [["2010", "2013", "2014"], ["2011"]]  # 2011 has a rival of a row of 2010 and no row of these years


def test_only_keys_with_several_rows_are_dealt(spark, tmp_path, counties, monkeypatch):
    landed, root = tmp_path / "landed", str(tmp_path / "table")
    dealt, unique, balanced, hints = [], silver.unique_keyed, tables.balanced, []
    monkeypatch.setattr(silver, "unique_keyed", lambda rows: (dealt.append(sorted(values(rows, "event_id"))), unique(rows))[1])
    monkeypatch.setattr(tables, "balanced", lambda df, *columns: (hints.append(columns), balanced(df, *columns))[1])

    def check(*asked):
        assert dealt == list(asked) and hints == []
        monkeypatch.setattr(silver, "unique_keyed", unique)
        assert same_rows(commits.current(spark, root), full(spark, landed, counties))
        monkeypatch.setattr(silver, "unique_keyed", lambda rows: (dealt.append(sorted(values(rows, "event_id"))), unique(rows))[1])
        dealt.clear()

    land(landed, 2010, "20240101", *(report(k, 2010) for k in range(1, 9)), report(3, 2010, injuries=4))
    incremental.update_events(spark, str(landed), root, counties, "r1")
    check(["3", "3"])
    # 2 competes within the new year and with 2010, 8 with 2010 only
    land(landed, 2011, "20240101", report(2, 2011), report(2, 2011, injuries=0), report(8, 2011, injuries=0), report(9, 2011))
    incremental.update_events(spark, str(landed), root, counties, "r2")
    check(["2", "2", "2", "3", "3", "8", "8"])
    land(landed, 2012, "20240101", report(20, 2012), report(21, 2012, "Z"))
    incremental.update_events(spark, str(landed), root, counties, "r3")
    check([])
    # more keys than a filter is made of: all rows of 2010 and 2011, and one of 2013
    monkeypatch.setattr(dedupe, "MOST_KEYS", 1)
    land(landed, 2013, "20240101", report(9, 2013, injuries=0))
    fourth = incremental.update_events(spark, str(landed), root, counties, "r4")
    assert fourth.years == (2011, 2013)
    check(["2", "2", "2", "8", "8", "9", "9"])
    assert not list((tmp_path / "table" / "repeats").glob("*"))


def test_rows_are_told_apart_by_keys(spark):
    rows = spark.range(20_000).selectExpr("cast(id % 15000 AS string) AS a", "if(id % 11 = 0, NULL, id % 3) AS b", "id")
    found = rows.filter("id % 7 = 0").select("a", "b").distinct()
    without, with_key = dedupe.split_by_keys(rows, found, ("a", "b"), found.count())
    assert without.columns == with_key.columns == rows.columns and without.unionByName(with_key).exceptAll(rows).isEmpty()
    known = {(r.a, r.b) for r in found.collect()}
    have = [r for r in rows.collect() if (r.a, r.b) in known]
    assert without.count() + with_key.count() == 20_000
    assert not [r for r in without.collect() if (r.a, r.b) in known] and len(have) <= with_key.count() <= len(have) + 200
    none, some = dedupe.split_by_keys(rows, found.limit(0), ("a", "b"), 0)
    assert none.count() == 20_000 and some.isEmpty()


def test_the_query_lands_reports_without_a_shuffle(spark, counties, monkeypatch):
    lines = [report(k, year).strip().split(",") for k in range(1, 40) for year in ((1996, 1998, "n/a")[k % 3],) if year != "n/a"]
    lines += [report(2, 1999, injuries=0).strip().split(","), [*report(50, 1999).split(",")[:9], "n/a", *report(50, 1999).strip().split(",")[10:]]]
    header = [c for c in HEADER.strip().split(",")]
    raw = spark.createDataFrame(lines, ", ".join(f"c{k} string" for k in range(len(header)))).toDF(*header[:10], "Year2", *header[11:]).drop("Year2")
    made = SimpleNamespace(spark=spark, raw=lambda name: raw, counties=lambda: counties)

    def no_shuffle(df, *columns):
        raise AssertionError(columns)

    monkeypatch.setattr(tables, "balanced", no_shuffle)
    found = QUERIES["sv1_incremental_run"](made)
    want = silver.clean_events(raw, counties).filter("county_fips_mapping_method NOT IN ('unresolved', 'non_county_zone')").select(*found.columns)
    assert same_rows(found, want) and found.count() > 0
