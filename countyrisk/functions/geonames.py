"""Place names: normal form for matching and display names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that name the kind of area, dropped before matching.
AREA_WORDS = (
    "CITY AND BOROUGH",
    "CENSUS AREA",
    "COUNTY",
    "PARISH",
    "BOROUGH",
    "MUNICIPALITY",
    "MUNICIPIO",
    "CITY",
)

# Display names of the Alaska county equivalents.
ALASKA_NAMES = {
    "02013": "Aleutians East Borough",
    "02016": "Aleutians West Census Area",
    "02020": "Anchorage Municipality",
    "02050": "Bethel Census Area",
    "02060": "Bristol Bay Borough",
    "02063": "Chugach Census Area",
    "02066": "Copper River Census Area",
    "02068": "Denali Borough",
    "02070": "Dillingham Census Area",
    "02090": "Fairbanks North Star Borough",
    "02100": "Haines Borough",
    "02105": "Hoonah-Angoon Census Area",
    "02110": "Juneau City and Borough",
    "02122": "Kenai Peninsula Borough",
    "02130": "Ketchikan Gateway Borough",
    "02150": "Kodiak Island Borough",
    "02158": "Kusilvak Census Area",
    "02164": "Lake and Peninsula Borough",
    "02170": "Matanuska-Susitna Borough",
    "02180": "Nome Census Area",
    "02185": "North Slope Borough",
    "02188": "Northwest Arctic Borough",
    "02195": "Petersburg Borough",
    "02198": "Prince of Wales-Hyder Census Area",
    "02220": "Sitka City and Borough",
    "02230": "Skagway Municipality",
    "02240": "Southeast Fairbanks Census Area",
    "02275": "Wrangell City and Borough",
    "02282": "Yakutat City and Borough",
    "02290": "Yukon-Koyukuk Census Area",
}

# The one state whose names carry a misspelt suffix in the sources.
SUFFIXED_STATE, SUFFIXED_STATE_MISSPELT = "Connecticut", "Conneccticut"


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def normal_name(c: Column | str) -> Column:
    """Upper-case words of a place without state, zone marker or kind of area."""
    raw = _text(c)
    name = F.substring_index(F.upper(F.trim(raw)), ",", 1)
    name = F.regexp_replace(F.replace(name, F.lit("&"), F.lit(" AND ")), r"\([A-Z]\)", " ")
    name = F.regexp_replace(name, rf"\b({'|'.join(AREA_WORDS)})\b", " ")
    name = F.trim(F.regexp_replace(name, "[^A-Z0-9]+", " "))
    return F.when(F.trim(raw) != "", name)


def compact_name(c: Column | str) -> Column:
    """A normal name without spaces, so that DE KALB meets DEKALB."""
    raw = F.trim(_text(c))
    return F.when(raw != "", F.regexp_replace(raw, r"\s+", ""))


def without_state_suffix(name: Column | str, state: Column | str) -> Column:
    """Drop ``, <state>`` at the end, with the row's own state; NULL if it is absent."""
    name, state = _text(name), _text(state)
    suffix = F.concat(F.lit(r",\s*"), state, F.lit("$"))
    stripped = F.trim(F.regexp_replace(name, suffix, F.lit("")))
    misspelt = rf",\s*{SUFFIXED_STATE_MISSPELT}$"
    return F.when(F.regexp_like(name, suffix), stripped).when(
        (state == SUFFIXED_STATE) & name.rlike(misspelt),
        F.trim(F.regexp_replace(name, misspelt, "")),
    )


def without_last_part(name: Column | str) -> Column:
    """Drop the text after the last comma."""
    return F.trim(F.regexp_replace(_text(name), r",\s*[^,]+$", ""))


def without_listed_state(name: Column | str) -> Column:
    """Drop ``, <state>`` at the end, for the one state that has it, well spelt or not."""
    cut = F.regexp_replace(_text(name), rf",\s*{SUFFIXED_STATE}$", "")
    return F.trim(F.regexp_replace(cut, rf",\s*{SUFFIXED_STATE_MISSPELT}$", ""))


def without_trailing_state(name: Column | str, state: Column | str) -> Column:
    """Drop the state written after a space, for the one state that has it."""
    cut = F.trim(F.regexp_replace(_text(name), f" +{SUFFIXED_STATE}$", ""))
    return F.when(_text(state) == SUFFIXED_STATE, cut).otherwise(_text(name))


def override_name(fips: Column | str) -> Column:
    """Fixed display name of a key, NULL for all other keys."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(ALASKA_NAMES.items())])
    return F.try_element_at(pairs, _text(fips))


def display_name(fips, nri_name, census_name) -> Column:
    """Fixed name, else the risk-index name, else the census name."""
    empty = F.lit("")
    return F.coalesce(
        override_name(fips), F.nullif(_text(nri_name), empty), F.nullif(_text(census_name), empty)
    )


def search_form(c: Column | str) -> Column:
    return F.lower(F.trim(_text(c)))
