"""Edge rows of the column functions."""

import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from countyrisk.functions import casts, damage, display, fips, geonames, names


def column(frame, fn, *rows):
    df = frame("c string", *rows)
    return values(df.select(fn("c").alias("out")), "out")


def test_snake_case():
    assert [names.snake_case(n) for n in ("BEGIN_DATE_TIME", " State Fips ", "a--b__c", "%$x", "fyDeclared")] == [
        "begin_date_time",
        "state_fips",
        "a_b_c",
        "x",
        "fydeclared",
    ]


def test_unique_names():
    assert names.unique_names(["year", "year", "name", "year"]) == ["year", "year__dup1", "name", "year__dup2"]


def test_restore_repeated_headers_touches_listed_names_only():
    read = ["YEAR0", "Year1", "b2", "NAME3", "NAME4"]
    assert names.restore_repeated_headers(read, ("year", "name")) == ["YEAR", "Year", "b2", "NAME", "NAME"]


def test_canonical_name_keeps_other_name_like_columns(frame):
    df = frame("name0 string, x int, name7 string, name_of_place string", (None, 1, "b", "p"), ("a", 2, "c", "q"))
    out = names.canonical_name_column(df)
    assert out.columns == ["name", "x", "name_of_place"]
    assert values(out, "name") == ["b", "a"]


def test_coalesce_and_projection(frame):
    df = frame("a string, b string", (None, "x"), ("y", "z"))
    assert values(names.coalesce_columns(df, ["a", "nope", "b"], "o"), "o") == ["x", "y"]
    assert names.coalesce_columns(df, ["nope"], "o").columns == ["a", "b"]
    shaped = names.project_to(df, {"b": "string", "n": "double"})
    assert shaped.dtypes == [("b", "string"), ("n", "double")]


def test_key_from_codes(frame):
    df = frame("s string, c string", ("1", "1"), ("06", "037"), ("72", "1"), (None, "1"), ("47", "155"), ("1", None))
    assert values(df.select(fips.fips_from_codes("s", "c").alias("k")), "k") == [
        "01001",
        "06037",
        "72001",
        None,
        "47155",
        None,
    ]


def test_standard_key_and_sanity(frame):
    rows = ["6037", " 06037 ", "06-037", "abc", "1234567", "00001", "03001", "06000", None]
    assert column(frame, fips.standard_fips, *rows) == [
        "06037",
        "06037",
        "06037",
        "00000",
        "12345",
        "00001",
        "03001",
        "06000",
        None,
    ]
    sane = column(frame, lambda c: fips.is_sane_fips(fips.standard_fips(c)), *rows)
    assert sane == [True, True, True, False, True, False, False, False, False]
    assert column(frame, fips.fips_was_cut, "1234567", "12345", None) == [True, False, False]


def test_zone_key_and_state_recode(frame):
    df = frame("s string, z string, t string", ("6", "37", " c "), ("6", "37", "Z"), ("6", "37", None), ("6", None, "C"))
    assert values(df.select(fips.fips_from_zone("s", "z", "t").alias("k")), "k") == ["06037", None, None, None]
    assert column(frame, fips.recode_state, "99", "72", "6", " ", None) == ["72", "72", "06", None, None]




def test_zip_from_text(frame):
    assert column(frame, fips.zip_from_text, "02108", "501", "ZIP 90210", "12 90210-1", "", "none", None) == [
        "02108",
        "00501",
        "90210",
        "90210",
        None,
        None,
        None,
    ]


def test_user_key(frame):
    assert column(frame, fips.user_fips, " 6037", "06-037", "", None, "none", "1234567") == ["06037", "06037", "", "", "00000", "1234567"]
    assert column(frame, fips.is_user_fips, "06037", "1234567", "", None) == [True, False, False, False]


def test_damage_strict_and_lenient(frame):
    rows = [None, "", "0", "10", "10K", "2.5M", "1B", "10.00k", "$1,000", "K", ".5K", "abc", " 7K "]
    assert column(frame, damage.damage_usd_strict, *rows) == [
        0.0, 0.0, 0.0, 10.0, 1e4, 2.5e6, 1e9, 1e4, 0.0, 0.0, 0.0, 0.0, 7e3,
    ]
    assert column(frame, damage.damage_usd_lenient, *rows) == [
        None, None, 0.0, 10.0, 1e4, 2.5e6, 1e9, 1e4, 1000.0, None, 500.0, None, 7e3,
    ]
    with pytest.raises(ValueError):
        damage.damage_usd("c", "other")


def test_place_names(frame):
    rows = [
        "De Kalb (C)",
        "DeKalb County",
        "Baltimore city",
        "Baltimore County",
        "Juneau City and Borough",
        "Prince George's",
        "A & B Parish, LA",
        "St. Mary's Census Area",
        "  ",
        None,
    ]
    norm = column(frame, geonames.normal_name, *rows)
    assert norm == [
        "DE KALB",
        "DEKALB",
        "BALTIMORE",
        "BALTIMORE",
        "JUNEAU",
        "PRINCE GEORGE S",
        "A AND B",
        "ST MARY S",
        None,
        None,
    ]
    compact = column(frame, lambda c: geonames.compact_name(geonames.normal_name(c)), *rows)
    assert compact[0] == compact[1] == "DEKALB"


def test_display_names(frame):
    df = frame(
        "k string, n string, c string, s string",
        ("02020", "x", None, "Alaska"),
        ("01001", "Autauga", "Autauga County, Alabama", "Alabama"),
        ("01003", "", "Baldwin County, Alabama", "Alabama"),
        ("09001", None, "Fairfield County, Conneccticut", "Connecticut"),
    )
    named = df.select(geonames.display_name("k", "n", geonames.without_state_suffix("c", "s")).alias("o"))
    assert values(named, "o") == ["Anchorage Municipality", "Autauga", "Baldwin County", "Fairfield County"]
    assert len(geonames.ALASKA_NAMES) == 30


def test_report_times(frame):
    df = frame(
        "t string, y int",
        ("28-APR-10 14:45:00", 2010),
        ("28-APR-50 14:45:00", 1950),
        ("01-JAN-00 00:10:00", 1999),
        ("2010-04-28 14:45:00", 2010),
        ("4/8/2010 14:45:00", 2010),
        ("30-FEB-10 14:45:00", 2010),
        ("soon", 2010),
        ("", 2010),
        (None, 2010),
        ("28-XXX-10 14:45:00", 2010),
    )
    assert values(df.select(casts.parse_timestamp("t", "y").cast("timestamp_ntz").alias("o")), "o") == [
        dt.datetime(2010, 4, 28, 14, 45),
        dt.datetime(1950, 4, 28, 14, 45),
        dt.datetime(2000, 1, 1, 0, 10),
        dt.datetime(2010, 4, 28, 14, 45),
        dt.datetime(2010, 4, 8, 14, 45),
        None,
        None,
        None,
        None,
        None,
    ]


def test_casts_do_not_raise(frame):
    df = frame("a string, d string, y string", ("12.7", "2010-04-28T01:02:03.000Z", "FY2010"), ("5", "junk", "n/a"))
    typed = casts.try_dates(casts.try_casts(df, {"bigint": ["a", "absent"]}), ["d", "absent"])
    assert values(typed, "a") == [None, 5]
    assert values(typed, "d") == [dt.date(2010, 4, 28), None]
    assert values(df.select(casts.year_from_text("y").alias("o")), "o") == [2010, None]
    with pytest.raises(ValueError):
        casts.with_year(df)


def test_numbers_are_told_before_the_cast(frame):
    texts = ["", "  ", "x", "EF1", "1.5", " 7 ", "+3", "-2", "99999999999", "Infinity", "-inf", " NaN", "0x1p3", "1e3", "n/a", "\x7f5", "\t8", None]
    df = frame("c string", *texts)
    for kind in casts.NUMBER_MARK:
        both = df.select(casts.try_number("c", kind).cast("string").alias("a"), F.col("c").try_cast(kind).cast("string").alias("b"))
        assert values(both, "a") == values(both, "b")
    plan = casts.try_casts(df, {"int": ["c"]})._jdf.queryExecution().analyzed().toString()
    assert "RLIKE" in plan


def test_money_labels(frame):
    df = frame("v double", 1.5e9, 2.25e6, -3000.0, 12.0, None)
    assert values(df.select(display.money_label("v").alias("o")), "o") == ["$1.50B", "$2.25M", "$-3.00K", "$12", "—"]


def test_map_attributes(frame):
    df = frame("v double", -5.0, 0.0, 50.0, 100.0, None)
    out = df.select(
        display.point_radius("v", F.lit(100.0)).alias("r"),
        display.point_radius("v", F.lit(0.0)).alias("flat"),
        display.point_colour_index("v", F.lit(100.0)).alias("c"),
        display.point_colour(display.point_colour_index("v", F.lit(100.0))).alias("rgba"),
        display.highlight_radius(display.point_radius("v", F.lit(100.0))).alias("h"),
    ).collect()
    assert [r.r for r in out] == [2000.0, 2000.0, 21000.0, 40000.0, 2000.0]
    assert {r.flat for r in out} == {25000.0}
    assert [r.c for r in out] == [50, 50, 140, 230, 50]
    assert out[3].rgba == [230, 60, 55, 160]
    assert [r.h for r in out] == pytest.approx([4000.0, 4000.0, 29400.0, 56000.0, 4000.0])
