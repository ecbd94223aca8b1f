"""County keys for storm reports: by code, by unique name, by unique compact name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fips, geonames
from ..functions.names import coalesce_columns
from . import keys
from .dedupe import dedupe

DIRECT, BY_NAME, BY_COMPACT = "direct_code", "name_match", "name_match_compact"
UNRESOLVED, NON_COUNTY = "unresolved", "non_county_zone"
METHOD = "county_fips_mapping_method"
OUTCOME = "outcome"


def canonical_counties(reference: DataFrame) -> DataFrame:
    """One row per county key with state code and matching names.

    ``reference`` is the normalised risk-index file. ``stcofips`` is preferred over
    the state and county codes.
    """
    columns = reference.columns
    if "stcofips" in columns:
        code = F.when(F.trim("stcofips") != "", F.col("stcofips").cast("string"))
    elif "statefips" in columns and "countyfips" in columns:
        code = fips.fips_from_codes("statefips", "countyfips")
    else:
        raise ValueError("the reference has neither stcofips nor statefips and countyfips")
    named = coalesce_columns(reference, ("county", "county_name", "countyname", "name"), "__place")
    if "__place" not in named.columns:
        named = named.withColumn("__place", F.lit(None).cast("string"))
    state = fips.state_code("statefips") if "statefips" in columns else F.substring(code, 1, 2)
    shaped = named.select(
        fips.standard_fips(code).alias("county_fips"),
        state.alias("state_fips_norm"),
        geonames.normal_name("__place").alias("county_name_norm"),
    ).withColumn("county_name_compact", geonames.compact_name("county_name_norm"))
    return dedupe(keys.keep_sane(shaped), ["county_fips"])


def unique_name_lookup(counties: DataFrame, name: str, out: str) -> DataFrame:
    """(state, name) pairs that stand for exactly one county, in one aggregation."""
    return (
        counties.filter(F.col("state_fips_norm").isNotNull() & F.col(name).isNotNull())
        .groupBy("state_fips_norm", name)
        .agg(F.count("*").alias("__n"), F.min("county_fips").alias(out))
        .filter("__n = 1")
        .drop("__n")
    )


def with_candidate_key(events: DataFrame) -> DataFrame:
    """Zone type, state code, candidate key and matching names of storm reports."""
    kind = fips.zone_type("cz_type") if "cz_type" in events.columns else F.lit(None).cast("string")
    name = geonames.normal_name("cz_name") if "cz_name" in events.columns else F.lit(None).cast("string")
    out = events.withColumns(
        {"cz_type_norm": kind, "state_fips_norm": fips.recode_state("state_fips"), "cz_name_norm": name}
    )
    by_code = fips.standard_fips(F.when(F.col("cz_type_norm") == "C", fips.fips_from_codes("state_fips", "cz_fips")))
    candidate = F.when(
        F.col("state_fips_norm") == fips.PUERTO_RICO, fips.fips_from_codes("state_fips_norm", "cz_fips")
    ).otherwise(by_code)
    return out.withColumns(
        {
            "county_fips": candidate,
            "county_fips_raw_candidate": candidate,
            "cz_name_compact": geonames.compact_name("cz_name_norm"),
        }
    )


def resolve_counties(events: DataFrame, counties: DataFrame) -> DataFrame:
    """Set ``county_fips`` and the method for every row of a frame with candidates.

    The three lookups hold at most one row per county (see :mod:`.keys`), so the
    event side is never shuffled. The joins are plain equalities; precedence is in
    the final expression.
    """
    by_code = keys.key_set(counties, out="__code")
    by_name = unique_name_lookup(counties, "county_name_norm", "__by_name").select(
        F.col("state_fips_norm").alias("__name_state"), F.col("county_name_norm").alias("__name"), "__by_name"
    )
    by_compact = unique_name_lookup(counties, "county_name_compact", "__by_compact").select(
        F.col("state_fips_norm").alias("__compact_state"),
        F.col("county_name_compact").alias("__compact"),
        "__by_compact",
    )
    is_county = F.coalesce(F.col("cz_type_norm") == "C", F.lit(False))
    state = F.col("state_fips_norm")
    matched = (
        events.join(by_code, keys.trimmed_key("county_fips") == F.col("__code"), "left")
        .join(
            by_name,
            (state == F.col("__name_state")) & (F.col("cz_name_norm") == F.col("__name")),
            "left",
        )
        .join(
            by_compact,
            (state == F.col("__compact_state")) & (F.col("cz_name_compact") == F.col("__compact")),
            "left",
        )
    )
    method = (
        F.when(~is_county, NON_COUNTY)
        .when(F.col("__code").isNotNull(), DIRECT)
        .when(F.col("__by_name").isNotNull(), BY_NAME)
        .when(F.col("__by_compact").isNotNull(), BY_COMPACT)
        .otherwise(UNRESOLVED)
    )
    resolved = F.coalesce("__code", "__by_name", "__by_compact")
    return matched.withColumns(
        {"county_fips": F.when(is_county, resolved).otherwise(F.col("county_fips")), METHOD: method}
    ).drop("__code", "__name_state", "__name", "__by_name", "__compact_state", "__compact", "__by_compact")


def with_outcome(resolved: DataFrame) -> DataFrame:
    """``valid``, ``unresolved`` or ``non_county``: the table each row belongs to."""
    outcome = (
        F.when(F.col(METHOD) == NON_COUNTY, "non_county")
        .when(F.col(METHOD) == UNRESOLVED, "unresolved")
        .otherwise("valid")
    )
    return resolved.withColumn(OUTCOME, outcome)


def split_outcomes(resolved: DataFrame) -> dict[str, DataFrame]:
    """The three outputs as filters over one classified frame."""
    labelled = with_outcome(resolved)
    return {
        name: labelled.filter(F.col(OUTCOME) == name).drop(OUTCOME)
        for name in ("valid", "unresolved", "non_county")
    }
