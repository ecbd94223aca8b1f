"""Contracts of the two marts: columns, types, NULL rules, grain, tolerance."""

from __future__ import annotations

from .. import schemas

_KEY = {"type": "string", "required": True}
_COUNT = {"type": "bigint", "required": True, "non_negative": True}
_MEASURE = {"type": "double", "required": True, "non_negative": True}
_OPTIONAL_MEASURE = {"type": "double", "required": False, "non_negative": True}

HAZARD_EVENT_SUMMARY = {
    "grain": ("county_fips", "year", "hazard_type", "hazard_category"),
    "columns": {
        "county_fips": _KEY,
        "year": {"type": "int", "required": True},
        "hazard_type": _KEY,
        "hazard_category": _KEY,
        "event_count": _COUNT,
        "total_fatalities": _COUNT,
        "total_injuries": _COUNT,
        "avg_property_damage": _OPTIONAL_MEASURE,
    },
}

_REQUIRED_CLAIMS = (
    "fema_valid_registrations",
    "fema_total_damage",
    "fema_total_approved_ihp_amount",
    "fema_declaration_count",
)

RISK_FEATURE_MART = {
    "grain": ("county_fips", "year"),
    "columns": {
        "county_fips": _KEY,
        "year": {"type": "int", "required": True},
        **{c: _MEASURE for c in schemas.EVENT_FEATURES},
        **{c: _MEASURE if c in _REQUIRED_CLAIMS else _OPTIONAL_MEASURE for c in schemas.CLAIM_FEATURES},
        **{c: {"type": "bigint", "required": False} for c in schemas.CENSUS_MEASURES},
        "census_acs_year": {"type": "int", "required": False},
        **{c: {"type": "double", "required": False} for c in schemas.NRI_SCORES.values()},
    },
    # Greatest percentage of NULLs per column family.
    "null_tolerance": [
        ((*schemas.CENSUS_MEASURES, "census_acs_year"), 5.0),
        (tuple(schemas.NRI_SCORES.values()), 5.0),
    ],
}
