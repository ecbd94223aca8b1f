"""Operators on small frames, with properties and hot keys."""

import math
from collections import defaultdict
from fractions import Fraction

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from countyrisk.config import YearWindow
from countyrisk.operators import allocate, checks, dedupe, keys, ranking, resolve, rollups
from countyrisk.operators.checks import WARNING, Check, Suite

W = YearWindow(2010, 2023)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- duplicates ---------------------------------------------------------------------


def test_dedupe_takes_newest_then_smallest(frame):
    df = frame(
        "id string, run_dt string, v string",
        ("a", "2024-01-01", "1"),
        ("a", "2024-02-01", "3"),
        ("a", "2024-02-01", "2"),
        ("b", None, "9"),
        ("b", "2024-01-01", "8"),
        (None, "2024-01-01", "n"),
        (None, "2024-01-01", "m"),
    )
    assert rows(dedupe.dedupe(df, ["id"]).select("id", "v")) == [("a", "2"), ("b", "8"), (None, "m")]
    assert dedupe.dedupe(df, ["absent"]) is df
    assert rows(dedupe.dedupe_with_fallback(df, ["absent"], ["id"]).select("v")) == [("2",), ("8",), ("m",)]


@SLOW
@given(data=st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["x", "y", None]), st.integers(0, 3)), max_size=25))
def test_dedupe_is_idempotent_and_complete(spark, data):
    df = spark.createDataFrame(data, "k int, run_dt string, v int")
    once = dedupe.dedupe(df, ["k"])
    assert rows(dedupe.dedupe(once, ["k"])) == rows(once)
    assert set(values(once, "k")) == {k for k, _, _ in data}
    assert set(rows(once)) <= set(data)


def test_surrogate_key_null_token(frame):
    df = frame("a string, b string, c string", ("x", None, "y"), ("x", "y", None))
    skipped = values(dedupe.surrogate_key(df, "abc", "k"), "k")
    kept = values(dedupe.surrogate_key(df, "abc", "k", "~"), "k")
    assert skipped[0] == skipped[1] and kept[0] != kept[1]


# --- resolution ---------------------------------------------------------------------


@pytest.fixture()
def counties(frame):
    raw = frame(
        "stcofips string, statefips string, county string",
        ("24005", "24", "Baltimore County"),
        ("24510", "24", "Baltimore city"),
        ("13089", "13", "DeKalb County"),
        ("6037", "6", "Los Angeles"),
        ("06037", "06", "Zzz"),
        ("", "13", "Nowhere"),
        ("13000", "13", "State row"),
    )
    return resolve.canonical_counties(raw)


def test_reference_is_unique_by_key(counties):
    assert rows(counties.select("county_fips", "county_name_norm")) == [
        ("06037", "LOS ANGELES"),
        ("13089", "DEKALB"),
        ("24005", "BALTIMORE"),
        ("24510", "BALTIMORE"),
    ]


def test_resolution_cascade(frame, counties):
    events = frame(
        "event_id string, state_fips string, cz_fips string, cz_type string, cz_name string",
        ("direct", "6", "37", "C", "anything"),
        ("name", "6", "999", "C", "Los Angeles (C)"),
        ("compact", "13", "999", "C", "De Kalb (C)"),
        ("ambiguous", "24", "999", "C", "Baltimore"),
        ("none", "6", "999", "C", None),
        ("zone", "6", "37", "Z", "Los Angeles"),
        ("untyped", "6", "37", None, "Los Angeles"),
        ("puerto rico zone", "99", "1", "Z", "x"),
    )
    out = resolve.resolve_counties(resolve.with_candidate_key(events), counties)
    got = {r.event_id: (r.county_fips, r[resolve.METHOD]) for r in out.collect()}
    assert got == {
        "direct": ("06037", "direct_code"),
        "name": ("06037", "name_match"),
        "compact": ("13089", "name_match_compact"),
        "ambiguous": (None, "unresolved"),
        "none": (None, "unresolved"),
        "zone": (None, "non_county_zone"),
        "untyped": (None, "non_county_zone"),
        "puerto rico zone": ("72001", "non_county_zone"),
    }
    assert not [c for c in out.columns if c.startswith("__")]
    parts = {k: v.count() for k, v in resolve.split_outcomes(out).items()}
    assert parts == {"valid": 3, "unresolved": 2, "non_county": 3}


def test_reference_falls_back_to_codes(frame):
    raw = frame("statefips string, countyfips string, name string", ("1", "1", "Autauga"))
    assert values(resolve.canonical_counties(raw), "county_fips") == ["01001"]
    with pytest.raises(ValueError):
        resolve.canonical_counties(frame("county string", "x"))


def test_canonical_filters_and_quarantine(frame):
    df = frame("county_fips string", "01001", " 01003 ", "99999", None, "abc")
    ref = frame("county_fips string", "01001", "01001", "01003")
    assert rows(keys.keep_canonical(df, ref)) == [(" 01003 ",), ("01001",)]
    assert rows(keys.not_canonical(df, ref)) == [("99999",), ("abc",), (None,)]
    good, bad = keys.split_by_sanity(frame("county_fips string", "01001", "00001", None))
    assert rows(good) == [("01001",)] and rows(bad) == [("00001",), (None,)]


# --- allocation -----------------------------------------------------------------------

CLAIM_DDL = (
    "disasternumber bigint, state string, zipcode string, validregistrations bigint, totaldamage double, totalapprovedihpamount double, "
    "repairreplaceamount double, rentalamount double, otherneedsamount double, totalinspected bigint"
)
DECL_DDL = "disasternumber bigint, state string, fydeclared bigint, county_fips string"
XWALK_DDL = "zip5 string, county_fips string, year int, tot_ratio double"


def claim(disaster, state, zipcode, n, damage=0.0):
    return (disaster, state, zipcode, n, damage, None, None, None, None, 1)


def test_weighted_allocation_edges(frame):
    claims = frame(
        CLAIM_DDL,
        claim(1, "LA", "70001", 10, 100.0),
        claim(1, " LA ", "70001", 10, None),
        claim(1, "LA", "501", 8),
        claim(1, "LA", "99999", 5),
        claim(1, "TX", "70001", 5),
        claim(2, "LA", "70001", 4),
        claim(None, "LA", "70001", 4),
        claim(1, "LA", None, 4),
    )
    declarations = frame(
        DECL_DDL, (1, "LA", 2012, "22001"), (1, "LA", 2012, "22003"), (2, "LA", 2012, None), (2, "LA", 2013, None), (2, "LA", 2009, None)
    )
    crosswalk = frame(
        XWALK_DDL,
        ("70001", "22001", 2012, 0.5),
        ("70001", "22003", 2012, 0.25),
        ("70001", "22001", 2013, None),
        ("00501", "22005", 2012, 1.0),
        ("70001", "00001", 2012, 1.0),
    )
    for kind in ("double", "decimal(18,4)"):
        out = allocate.allocate_by_zip(claims, declarations, crosswalk, W, kind)
        got = {
            (r.county_fips, r.year): (r.fema_valid_registrations, r.fema_total_damage, r.fema_declaration_count)
            for r in out.collect()
        }
        assert got == {
            ("22001", 2012): (12.0, 50.0, 2),
            ("22003", 2012): (6.0, 25.0, 2),
            ("22001", 2013): (4.0, 0.0, 1),
            ("22005", 2012): (8.0, 0.0, 1),
        }
    assert rows(allocate.disaster_fan_out(declarations, W)) == [(2, "LA", 2)]


_SHARES = st.sampled_from([0.0, 0.25, 0.5, 1.0, None])


@SLOW
@given(
    claimed=st.lists(st.tuples(st.integers(1, 3), st.integers(1, 4), st.integers(0, 50)), min_size=1, max_size=30),
    shares=st.dictionaries(st.tuples(st.integers(1, 4), st.integers(1, 3)), _SHARES, min_size=1, max_size=12),
)
def test_allocation_law(spark, claimed, shares):
    """What is allocated equals measure times share over all matching claims."""
    claims = spark.createDataFrame([claim(d, "LA", f"7000{z}", n) for d, z, n in claimed], CLAIM_DDL)
    declarations = spark.createDataFrame([(d, "LA", 2010 + d, None) for d in (1, 2, 3)], DECL_DDL)
    crosswalk = spark.createDataFrame(
        [(f"7000{z}", f"2200{c}", y, r) for (z, c), r in shares.items() for y in (2011, 2012, 2013)], XWALK_DDL
    )
    expected = sum(
        Fraction(n) * Fraction(1.0 if r is None else r) for d, z, n in claimed for (z2, _), r in shares.items() if z2 == z
    )
    out = allocate.allocate_by_zip(claims, declarations, crosswalk, W)
    assert math.isclose(sum(values(out, "fema_valid_registrations")), float(expected), abs_tol=1e-9)


def test_equal_allocation_keeps_the_total(frame):
    claims = frame(CLAIM_DDL, claim(1, "LA", "70001", 9, 90.0), claim(2, "LA", "70001", 5, 50.0))
    declarations = frame(DECL_DDL, (1, "LA", 2012, "22001"), (1, "LA", 2012, "22003"), (1, "LA", 2012, "22003"), (1, "LA", 2012, "22005"))
    out = {r.county_fips: r.fema_total_damage for r in allocate.allocate_equally(claims, declarations).collect()}
    assert out == {"22001": 30.0, "22003": 30.0, "22005": 30.0}


def test_hot_zip_and_disaster_against_brute_force(spark):
    """A third of the claims on one disaster and ZIP gives the same sums as a plain loop."""
    base = spark.range(0, 30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 40 END AS disasternumber",
        "'LA' AS state",
        "CASE WHEN id % 3 = 0 THEN '70007' ELSE cast(70000 + id % 60 AS string) END AS zipcode",
        "id % 11 AS validregistrations",
        *[f"cast(id % 4 AS double) AS {c}" for c in ("totaldamage", "totalapprovedihpamount", "repairreplaceamount", "rentalamount", "otherneedsamount")],
        "1L AS totalinspected",
    )
    declarations = spark.createDataFrame([(d, "LA", 2010 + d % 5, None) for d in range(40)], DECL_DDL)
    crosswalk = spark.createDataFrame(
        [(str(70000 + z), f"220{z % 9 + 10}", y, 0.5) for z in range(60) for y in range(2010, 2015)], XWALK_DDL
    )
    want = defaultdict(float)
    for i in range(30000):
        d = 7 if i % 3 == 0 else i % 40
        z = 7 if i % 3 == 0 else i % 60
        want[(f"220{z % 9 + 10}", 2010 + d % 5)] += (i % 11) * 0.5
    out = allocate.allocate_by_zip(base, declarations, crosswalk, W)
    assert {(r.county_fips, r.year): r.fema_valid_registrations for r in out.collect()} == dict(want)


# --- roll-ups and rankings -----------------------------------------------------------------


def test_universe_has_every_pair(frame):
    counties, years = frame("county_fips string", "01001", "01003"), frame("year int", 2010, 2011, 2011)
    assert rows(rollups.county_year_universe(counties, years)) == [
        ("01001", 2010),
        ("01001", 2011),
        ("01003", 2010),
        ("01003", 2011),
    ]


MART_DDL = (
    "county_fips string, year int, nri_risk_score double, noaa_event_count bigint, fema_valid_registrations double, fema_total_damage double"
)


@pytest.fixture()
def mart(frame):
    return frame(
        MART_DDL,
        ("01003", 2010, None, 4, 2.0, 5.0),
        ("01001", 2010, 9.0, 4, 2.0, 5.0),
        ("01005", 2010, 9.0, 0, 7.0, 1.0),
        ("01001", 2011, 9.0, 0, 6.0, 2.0),
        ("01001", 2012, 9.0, 2, 1.0, 3.0),
    )


def test_rankings_put_nulls_last_and_break_ties(mart):
    top = lambda mode: values(ranking.rank_counties(mart, mode, 2010, 3), "county_fips")
    assert top("structural") == ["01001", "01005", "01003"]
    assert top("frequency") == ["01001", "01003", "01005"]
    assert top("outcomes") == ["01005", "01001", "01003"]
    assert values(ranking.rank_counties(mart, "impact", 2010, 1), "county_fips") == ["01001"]
    with pytest.raises(ValueError):
        ranking.rank_counties(mart, "other", 2010)
    assert values(ranking.quiet_but_risky(mart, 2010), "county_fips") == ["01005"]
    assert values(ranking.claim_intensity(mart, 2010, 2010), "claims_per_event") == [0.5, 0.5, None]


def test_filter_comes_after_the_rank_limit(mart):
    ranked = ranking.rank_counties(mart, "impact", 2010, 2)
    assert ranking.ranked_view(ranked, True, 5, [F.asc("county_fips")]).count() == 0


def test_trailing_mean_and_snapshot(mart):
    series = ranking.trailing_means(mart, 2).filter("county_fips = '01001'").orderBy("year")
    assert values(series, "noaa_events_roll2") == [4.0, 2.0, 1.0]
    assert rows(ranking.latest_snapshot(mart, ["fema_total_damage"])) == [
        ("01001", 2012, 3.0),
        ("01003", 2010, 5.0),
        ("01005", 2010, 1.0),
    ]


# --- checks -----------------------------------------------------------------------------


def failures(spark, table, *suite):
    return {r["name"]: r["failures"] for r in checks.run_checks(spark, Suite("s", table, suite)).collect()}


def test_row_checks_clean_and_seeded(spark, frame):
    clean = frame("k string, v double, year int", ("a", 1.0, 2010), ("b", None, 2011))
    dirty = frame("k string, v double, year int", (None, -1.0, 2010), ("b", 2.0, 1999), ("b", -3.0, None))
    tests = (
        Check("nulls", checks.any_null(["k", "year"])),
        Check("negative", checks.any_negative(["v"])),
        Check("window", checks.outside_window(2010, 2023)),
        Check("years", checks.year_complete()),
        Check("filled", checks.not_empty()),
        Check("pct", checks.null_pct_above(["v"], 50.0)),
    )
    assert set(failures(spark, clean, *tests).values()) == {0}
    assert failures(spark, dirty, *tests) == {"nulls": 2, "negative": 2, "window": 1, "years": 1, "filled": 0, "pct": 0}
    empty = failures(spark, clean.limit(0), *tests)
    assert empty["filled"] == 1 and empty["years"] == 1 and empty["pct"] == 1 and empty["nulls"] == 0


def test_key_checks(spark, frame):
    df = frame("county_fips string, year int", ("01001", 2010), ("01001", 2010), ("99999", 2011))
    ref = frame("county_fips string", "01001")
    universe = frame("county_fips string, year int", ("01001", 2010), ("01001", 2011))
    got = failures(
        spark,
        df,
        Check("unique", lambda: checks.unique(df, ("county_fips", "year"))),
        Check("canonical", lambda: checks.referential(df, ref)),
        Check("covers", lambda: checks.covers(df, universe, ("county_fips", "year"))),
        Check("columns", lambda: checks.required_columns(df, ["COUNTY_FIPS", "state"])),
    )
    assert got == {"unique": 1, "canonical": 1, "covers": 1, "columns": 1}
    assert checks.row_counts_equal(df, universe, ("a", "b")).collect() == [(3, 2)]
    assert checks.row_counts_equal(df, df, ("a", "b")).count() == 0


def test_grain_is_a_parameter(frame):
    df = frame("c string, y int, t string, k string", ("a", 1, "x", "p"), ("a", 1, "x", "q"))
    assert checks.unique(df, ("c", "y", "t")).first().failures == 1
    assert checks.unique(df, ("c", "y", "t", "k")).first().failures == 0


def test_broken_checks_count_as_failed(spark, frame):
    df = frame("a string", "x", "1")
    got = failures(
        spark,
        df,
        Check("no column", checks.any_null(["absent"])),
        Check("fails at run time", lambda: df.agg(F.sum(F.col("a").cast("int")).alias("failures"))),
        Check("not a number", lambda: df.limit(1).select(F.lit("oops").alias("failures"))),
        Check("good", checks.any_null(["a"])),
    )
    assert got == {"no column": -1, "fails at run time": -1, "not a number": -1, "good": 0}


def test_status_pass_warn_fail(spark, frame):
    df = frame("a int", 1, None)
    bad, good = checks.any_null(["a"]), checks.not_empty()

    def status(*suite):
        row = checks.overall_status(checks.suite_status(checks.run_checks(spark, Suite("s", df, suite)))).first()
        return row.status, row.block_downstream

    assert status() == ("pass", False)
    assert status(Check("g", good)) == ("pass", False)
    assert status(Check("g", good), Check("b", bad, WARNING)) == ("warn", False)
    assert status(Check("b", bad), Check("w", bad, WARNING)) == ("fail", True)


def test_match_rates(frame):
    claims, decls = frame("d bigint", 1, 1, 2, None), frame("d bigint", 2, 3, 4)
    assert tuple(checks.match_rate(claims, decls, "d").first()) == (2, 3, 1, 1, 0.5)
    assert checks.match_rate(claims.limit(0), decls, "d").first().match_rate == 0.0
    rate = checks.share_in_reference(frame("county_fips string", "01001", "01001", "x", None), frame("county_fips string", "01001"))
    assert tuple(rate.first()) == (4, 2, 0.5)


def test_null_rates(frame):
    df = frame("a string, b int", ("", 1), (" ", None), ("x", 2), (None, 3))
    assert tuple(checks.null_rates(df, ["a", "b", "absent"]).first()) == (0.75, 0.25)
    assert checks.null_rates(df, ["absent"]).first().note == "no_cols"


@pytest.mark.parametrize("count", [0, 1, 2, 7, 40_001, 40_002])
def test_exact_median_beyond_the_sketch(spark, count):
    rows = spark.range(count).selectExpr("CASE WHEN id % 11 = 0 THEN 5.5D WHEN id % 3 = 0 THEN NULL ELSE double(id * 7919 % 100003) / 3 END AS v")
    want = sorted(r.v for r in rows.collect() if r.v is not None)
    n = len(want)
    found = ranking.exact_median(rows, F.col("v")).first().median
    assert found == ((want[(n - 1) // 2] + want[n // 2]) / 2 if n else None)
    legend = ranking.metric_range(rows, "v").first()
    assert (legend.low, legend.median, legend.high) == (want[0] if n else None, found, want[-1] if n else None)


def test_headers_that_lack_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Event_ID",STATE , year\nEPISODE_ID,2,3\n')
    (tmp_path / "b.csv").write_text("EVENT_ID,EPISODE_ID,STATE,YEAR\n" + "1,2,3,4\n" * 50)
    found = checks.missing_headers(spark, str(tmp_path), ["event_id", "episode_id", "state", "year"]).collect()
    assert [(r.path.rsplit("/", 1)[1], r.missing) for r in found] == [("a.csv", ["episode_id"])]
