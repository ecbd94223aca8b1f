"""The shape of the plans: what is shuffled, broadcast, pushed down and pruned."""

import re
from collections import Counter
from types import SimpleNamespace

import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F

from countyrisk import schemas
from countyrisk.catalogue import geography  # noqa: F401 (it registers)
from countyrisk.catalogue.registry import QUERIES
from countyrisk.catalogue.workspace import WINDOW, workspace
from countyrisk.config import YearWindow
from countyrisk.operators import allocate, checks, dedupe, ranking, resolve
from countyrisk.plans import gold, pipeline, serving, silver
from countyrisk.sinks import tables


@pytest.fixture(scope="module")
def w(spark):
    return workspace(spark, SF)


def shuffles(df):
    return len(re.findall(r"[ \-+:*()0-9]Exchange (?:hash|range|Single|RoundRobin)", plan_of(df)))


def test_dedupe_reduces_before_its_one_shuffle(w):
    df = dedupe.dedupe(silver.keyed_events(w.raw("events")), ("event_id", "episode_id"))
    plan = plan_of(df)
    assert shuffles(df) == 1
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hash") < plan.index("row_number(), 1, Partial")


def test_resolution_does_not_shuffle_events(w):
    df = resolve.resolve_counties(resolve.with_candidate_key(w.raw("events").toDF(*[c.lower().replace(" ", "_") for c in w.raw("events").columns])), w.counties())
    plan = plan_of(df)
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    # every shuffle belongs to one of the three lookups, which hold one row per county
    spine = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Exchange")]
    assert spine and all(":" in line or "+-" in line for line in spine)
    assert "event_id" not in "".join(spine)


def test_mart_reads_only_what_it_needs(w):
    plan = plan_of(w.build_mart())
    events = next(p for p in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "damage_property" in p)
    assert "cz_name" not in events and "begin_date_time" not in events
    assert "PartitionFilters: [isnotnull(year" in plan
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(county_fips\)", plan)


def test_mart_joins_features_on_their_aggregation(w):
    spark = w.spark
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(w.build_mart())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    outer = plan[plan.index("FullOuter"):]
    # straight from the aggregates: a sort may come first, a shuffle may not
    head = outer[: outer.index("HashAggregate")]
    assert "Exchange" not in head


def test_allocation_aggregates_before_the_joins(w):
    plan = plan_of(allocate.allocate_by_zip(w.claims(), w.declarations(), w.crosswalk(), WINDOW))
    partial = plan.index("partial_sum(coalesce(")
    assert plan.rindex("Join", 0, partial) >= 0
    assert "SortMergeJoin" not in plan[partial:] and "BroadcastHashJoin" not in plan[partial : plan.index("FileScan", partial)]


def test_rankings_are_top_k(w):
    plan = plan_of(ranking.rank_counties(w.mart(), "impact", 1998, 100))
    assert "TakeOrderedAndProject" in plan and "PartitionFilters: [isnotnull(year" in plan
    assert "TakeOrderedAndProject" in plan_of(ranking.quiet_but_risky(w.mart(), 1998, 50))


def test_look_ups_of_one_key_are_pushed_down(w):
    for df in (serving.county_series(w.mart(), "4-004"), ranking.hazard_breakdown(w.summary(), "4004", 1998), serving.county_lookup(w.centroids(), "04004")):
        assert "EqualTo(county_fips,04004)" in plan_of(df)


def test_map_ranks_once(w):
    plan = plan_of(serving.map_payload(w.mart(), w.centroids(), "frequency", 1998))
    assert plan.count("TakeOrderedAndProject") <= 3


def largest_method(df):
    """Bytes of the largest generated method of a plan; the JVM leaves one over 8000 uncompiled."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan generates nothing before it runs
    try:
        parts = df.select("*")._jdf.queryExecution().debug().codegenToSeq().iterator()
        sizes = []
        while parts.hasNext():
            sizes.append(parts.next()._3().maxMethodCodeSize())
    finally:
        conf.set("spark.sql.adaptive.enabled", "true")
    return max(sizes)


def test_matching_and_typing_of_events_are_compiled(w, tmp_path):
    matched = silver.matched_events(silver.keyed_events(w.raw("events")), w.counties())
    matched.write.parquet(str(tmp_path / "matched"))
    typed = silver.typed_events(w.spark.read.parquet(str(tmp_path / "matched")))
    assert largest_method(matched) < 8000 and largest_method(typed) < 8000
    # the write types the rows after its shuffle
    written = tmp_path / "written"
    pipeline.write_events(matched, str(written))
    found = w.spark.read.parquet(str(written)).drop(resolve.OUTCOME)
    clean = silver.clean_events(w.raw("events"), w.counties())
    assert dict(found.dtypes) == dict(clean.dtypes)
    assert found.select(*clean.columns).exceptAll(clean).isEmpty() and found.count() == clean.count()


def test_events_are_written_where_their_duplicates_were_dropped(w, tmp_path, monkeypatch):
    def never(*_):
        raise AssertionError("dealt once more")

    monkeypatch.setattr(tables, "balanced", never)
    matched = silver.matched_events(silver.keyed_events(w.raw("events")), w.counties())
    pipeline.write_events(matched, str(tmp_path / "written"))
    clean = silver.clean_events(w.raw("events"), w.counties())
    found = w.spark.read.parquet(str(tmp_path / "written"))
    assert found.count() == clean.count() and found.select(*clean.columns).exceptAll(clean).isEmpty()
    written = silver.typed_events(tables.in_place(resolve.with_outcome(matched), resolve.OUTCOME, "year"))
    assert "REBALANCE" not in plan_of(written) and largest_method(written) < 8000
    # the write needs no sort of its own: rows of a folder lie together in each task
    assert plan_of(written).count("Sort [outcome") == 1


def test_no_shuffle_before_cleaning(w):
    assert "RoundRobin" not in plan_of(silver.clean_events(w.raw("events"), w.counties()))


def test_no_python_in_any_plan(w):
    for df in (w.build_mart(), gold.hazard_event_summary(w.events(), WINDOW), serving.year_kpis(w.mart())):
        assert "Python" not in plan_of(df) and "Pandas" not in plan_of(df)


def test_trailing_window_is_per_county(w):
    plan = plan_of(ranking.trailing_means(w.mart(), 5))
    assert "hashpartitioning(county_fips" in plan and "SinglePartition" not in plan


def test_universe_has_no_cross_join(w):
    plan = plan_of(gold.county_year_universe(w.dim(), w.years()))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Generate explode" in plan


def test_equal_shares_are_made_before_the_map(w):
    df = allocate.allocate_equally(w.claims(), w.declarations())
    assert "Cartesian" not in plan_of(df) and df.filter(F.col("county_fips").isNull()).count() == 0


def test_a_suite_scans_its_table_once(spark, tmp_path):
    mart = spark.createDataFrame([("01001", 2012, 1), ("01003", 2012, None), ("99999", 2012, -2)], "county_fips string, year int, n int")
    for name, df in (("mart", mart), ("universe", mart.select("county_fips", "year")), ("reference", mart.select("county_fips"))):
        df.write.parquet(str(tmp_path / name))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    suite = checks.Suite(
        "s",
        read("mart"),
        [
            checks.Check("nulls", checks.any_null(["n"])),
            checks.Check("negative", checks.any_negative(["n"])),
            checks.Check("unique", checks.Unique(("county_fips", "year"))),
            checks.Check("year_unique", checks.Unique(("year",))),
            checks.Check("canonical", checks.Referential(read("reference").filter("county_fips < '05'"))),
            checks.Check("covers", checks.Covers(read("universe"), ("county_fips", "year"))),
        ],
    )
    found = checks.check_frame(spark, suite)
    plan = plan_of(found)
    assert {r.name: r.failures for r in found.collect()} == {"nulls": 1, "negative": 1, "unique": 0, "year_unique": 1, "canonical": 1, "covers": 0}
    assert plan.count("FileScan") == 3 and plan.count("/mart]") == 1
    empty = checks.Suite("e", read("mart").filter("n > 100"), [*suite.checks, checks.Check("rows", checks.not_empty()), checks.Check("tolerance", checks.null_pct_above(["n"]))])
    want = {"nulls": 0, "negative": 0, "unique": 0, "year_unique": 0, "canonical": 0, "covers": 3, "rows": 1, "tolerance": 1}
    assert {r.name: r.failures for r in checks.check_frame(spark, empty).collect()} == want
    odd = spark.createDataFrame([(None, 2012), (None, 2012), (" 01001", 2012)], "county_fips string, year int")
    nulls = checks.Suite("n", odd, [checks.Check("u", checks.Unique(("county_fips", "year"))), checks.Check("r", checks.Referential(mart)), checks.Check("c", checks.Covers(odd, ("county_fips", "year")))])
    assert {r.name: r.failures for r in checks.check_frame(spark, nulls).collect()} == {"u": 1, "r": 1, "c": 2}


def test_claims_meet_the_crosswalk_summed_by_zip(spark):
    claims = [(d, "TX", z, 2.0) for d in range(1, 31) for z in ("75001", "75002") for _ in range(1 + (d % 2))]
    measures = ", ".join(f"{m} double" for m in schemas.CLAIM_MEASURES)
    claims = spark.createDataFrame([(d, s, z, *[v] * len(schemas.CLAIM_MEASURES)) for d, s, z, v in claims], f"disasternumber long, state string, zipcode string, {measures}")
    declared = spark.createDataFrame([(d, "TX", 2012) for d in range(1, 31)], "disasternumber long, state string, fydeclared long")
    shares = [(z, f"48{c:03d}", r, 2012) for z in ("75001", "75002") for c in range(1, 21) for r in (0.5, None)]
    shares = spark.createDataFrame(shares, "zip5 string, county_fips string, tot_ratio double, year int")
    found = allocate.allocate_by_zip(claims, declared, shares, YearWindow(2012, 2012))
    amount = next(iter(schemas.CLAIM_MEASURES.values()))
    got = {r["county_fips"]: (r[amount], r["fema_declaration_count"]) for r in found.collect()}
    assert got == {f"48{c:03d}": (2 * 45 * 2.0 * 1.5, 30) for c in range(1, 21)}
    plan = plan_of(found)
    assert "distinct disasternumber" not in plan
    pairs = plan[: plan.index("Generate explode(__counties")].splitlines()[-8:]  # they are told apart where they lie
    assert sum("HashAggregate" in line for line in pairs) >= 2 and "Exchange" not in "".join(pairs[-3:])


def test_pairs_of_claims_and_counties_are_not_grouped(spark):
    """Two states of a disaster, two fiscal years, repeated crosswalk rows and NULLs, against a plain loop."""
    claims = [(d, s, z) for d in (1, 2, 3, None) for s in ("LA", " LA", "TX", None) for z in ("70001", "ZIP 70001-9", "70002", "70003", None) for _ in range(d or 1)]
    declared = [(1, "LA", 1997), (1, " LA ", 1997), (1, "TX", 1997), (1, "LA", 1998), (2, "LA", 1998), (2, "TX", 2005), (3, "LA", None), (None, "LA", 1997)]
    shares = [(z, c, y, 0.5) for z in ("70001", " 70002 ", None) for c in ("22001", "22003", "22003", "22000", None) for y in (1997, 1998, 2005)]
    made = SimpleNamespace(
        claims=lambda: spark.createDataFrame(claims, "disasternumber long, state string, zipcode string"),
        declarations=lambda: spark.createDataFrame(declared, "disasternumber long, state string, fydeclared long"),
        crosswalk=lambda: spark.createDataFrame(shares, "zip5 string, county_fips string, year int, tot_ratio double"),
    )
    want = Counter()
    years = {(d, s.strip(), y) for d, s, y in declared if d and y and 1996 <= y <= 2000}
    for d, s, z in claims:
        zip5 = z and z.removeprefix("ZIP ")[:5]
        for e, t, y in years:
            if d == e and s and s.strip() == t:
                want.update((d, y, zip5, c) for x, c, at, _ in shares if x and x.strip() == zip5 and at == y and c in ("22001", "22003"))
    query = QUERIES["jn07_claims_declarations_crosswalk"]
    found = query(made)
    assert {(r.disasternumber, r.year, r.zip5, r.county_fips): r.claims for r in found.collect()} == dict(want) and found.count() == len(want) > 0
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(query(made))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not re.search("Aggregate|Exchange", plan[: plan.index("SortMergeJoin")])
    assert len(re.findall(r"Exchange hashpartitioning\(zip5#\d+, year#\d+, 8", plan)) == 2
