"""Five-digit county keys and ZIP codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# State codes that mark a placeholder key, and the recode of 99.
BAD_STATES = ("00", "03")
BAD_COUNTY = "000"
RECODED_STATE, PUERTO_RICO = "99", "72"


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def digits(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), "[^0-9]", "")


def standard_fips(c: Column | str) -> Column:
    """Digits only, padded to five; NULL stays NULL, longer text is cut to five."""
    return F.lpad(digits(c), 5, "0")


def fips_was_cut(c: Column | str) -> Column:
    """True where :func:`standard_fips` drops digits."""
    return F.coalesce(F.length(digits(c)) > 5, F.lit(False))


def sane_condition(c: Column | str) -> Column:
    """Five characters, no placeholder state, county part not 000. For filters.

    NULL for a NULL key, which a filter drops; left bare so that the planner can push
    the NULL test to the scan.
    """
    key = F.trim(_text(c))
    return (
        (F.length(key) == 5)
        & ~F.substring(key, 1, 2).isin(*BAD_STATES)
        & (F.substring(key, 3, 3) != BAD_COUNTY)
    )


def is_sane_fips(c: Column | str) -> Column:
    """:func:`sane_condition` as a flag that is never NULL."""
    return F.coalesce(sane_condition(c), F.lit(False))


def fips_from_codes(state: Column | str, county: Column | str) -> Column:
    """State padded to two and county to three, side by side; NULL if either is."""
    return F.concat(F.lpad(_text(state), 2, "0"), F.lpad(_text(county), 3, "0"))


def zone_type(c: Column | str) -> Column:
    text = F.upper(F.trim(_text(c)))
    return F.when(text != "", text)


def fips_from_zone(state: Column | str, zone: Column | str, kind: Column | str) -> Column:
    """Key of a storm report, only where the zone is a county (type C)."""
    return F.when(zone_type(kind) == "C", fips_from_codes(state, zone))


def state_code(c: Column | str) -> Column:
    """Two-digit state code; blank becomes NULL."""
    text = _text(c)
    return F.when(F.trim(text) != "", F.lpad(text, 2, "0"))


def recode_state(c: Column | str) -> Column:
    """As :func:`state_code`, with 99 read as Puerto Rico."""
    code = state_code(c)
    return F.when(code == RECODED_STATE, F.lit(PUERTO_RICO)).otherwise(code)


def state_digits(c: Column | str) -> Column:
    """Two-digit state code from text with stray characters; blank becomes NULL."""
    return F.when(F.trim(_text(c)) != "", F.lpad(digits(c), 2, "0"))


def padded_zip(c: Column | str) -> Column:
    """ZIP of the crosswalk: text padded to five."""
    return F.lpad(_text(c), 5, "0")


def zip_from_text(c: Column | str) -> Column:
    """First five digits in a row, else the first shorter run padded to five.

    NULL when the text holds no digit. Plain digits, the usual case, are told without
    a regular expression.
    """
    text = F.trim(_text(c))
    plain = F.length(text).between(1, 5) & (F.translate(text, "0123456789", "") == "")
    five = F.nullif(F.regexp_extract(text, r"([0-9]{5})", 1), F.lit(""))
    short = F.nullif(F.regexp_extract(text, r"([0-9]+)", 1), F.lit(""))
    return F.when(plain, F.lpad(text, 5, "0")).otherwise(F.coalesce(five, F.lpad(short, 5, "0")))


def user_fips(c: Column | str) -> Column:
    """Key typed by a user: digits only, zero-filled to five (text without digits is 00000);
    empty stays empty."""
    found = F.coalesce(digits(c), F.lit(""))
    blank = F.coalesce(F.trim(_text(c)), F.lit("")) == ""
    return F.when(blank, "").when(F.length(found) > 5, found).otherwise(F.lpad(found, 5, "0"))


def user_key(text: str) -> str:
    """:func:`user_fips` of one text, as a literal that a scan can be filtered by."""
    found = "".join(c for c in text if c in "0123456789")
    if not text.strip():
        return ""
    return found if len(found) > 5 else found.rjust(5, "0")


def is_user_fips(c: Column | str) -> Column:
    return F.coalesce(_text(c).rlike(r"^[0-9]{5}$"), F.lit(False))
