"""Schemas of the raw, cleaned and mart tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """``"a string, b bigint"`` as a schema; needs no running session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _acs(table: str, cells: int, annotated: bool = True) -> T.StructType:
    """Census table: per cell an estimate, a margin and an annotation of each."""
    columns = ["name string"]
    for n in range(1, cells + 1):
        cell = f"{table}_{n:03d}"
        columns.append(f"{cell}e bigint")
        if annotated:
            columns.append(f"{cell}ea string, {cell}m bigint, {cell}ma string")
    if annotated:
        columns.append("geo_id string")
    return _schema(", ".join([*columns, "state bigint", "county bigint"]))


# Column names of the public raw files, in file order.
DECLARATIONS = _schema(
    """femadeclarationstring string, disasternumber bigint, state string, declarationtype string,
    declarationdate string, fydeclared bigint, incidenttype string, declarationtitle string,
    ihprogramdeclared bigint, iaprogramdeclared bigint, paprogramdeclared bigint,
    hmprogramdeclared bigint, incidentbegindate string, incidentenddate string,
    disastercloseoutdate string, tribalrequest bigint, fipsstatecode bigint, fipscountycode bigint,
    placecode bigint, designatedarea string, declarationrequestnumber bigint,
    lastiafilingdate string, incidentid bigint, region bigint, designatedincidenttypes string,
    lastrefresh string, hash string, id string"""
)

OWNERS = _schema(
    """disasternumber bigint, state string, county string, city string, zipcode string,
    validregistrations bigint, averagefemainspecteddamage double, totalinspected bigint,
    totaldamage double, nofemainspecteddamage bigint, femainspecteddamagebetween1and10000 bigint,
    femainspecteddamagebetween10001and20000 bigint, femainspecteddamagebetween20001and30000 bigint,
    femainspecteddamagegreaterthan30000 bigint, approvedforfemaassistance bigint,
    totalapprovedihpamount double, repairreplaceamount double, rentalamount double,
    otherneedsamount double, approvedbetween1and10000 bigint, approvedbetween10001and25000 bigint,
    approvedbetween25001andmax bigint, totalmaxgrants bigint, id string"""
)

RENTERS = _schema(
    """disasternumber bigint, state string, county string, city string, zipcode string,
    validregistrations bigint, totalinspected bigint, totalinspectedwithnodamage bigint,
    totalwithmoderatedamage bigint, totalwithmajordamage bigint, totalwithsubstantialdamage bigint,
    approvedforfemaassistance bigint, totalapprovedihpamount double, repairreplaceamount double,
    rentalamount double, otherneedsamount double, approvedbetween1and10000 bigint,
    approvedbetween10001and25000 bigint, approvedbetween25001andmax bigint, totalmaxgrants bigint,
    id string"""
)


def _risk_index() -> T.StructType:
    """County risk index: general columns, then the same measures for each hazard.

    The declared table gives some measures of some hazards as text where others are
    numbers; here a measure has one type for all hazards: ratings are text, all else numbers.
    """
    # General columns, hazards (with crops at risk or not), measures in file order.
    head = """objectid bigint, nri_id string, state string, stateabbrv string, statefips string,
        county string, countytype string, countyfips bigint, stcofips bigint, population bigint,
        buildvalue bigint, agrivalue bigint, area double, risk_value double, risk_score double,
        risk_ratng string, risk_spctl double, eal_score double, eal_ratng string, eal_spctl double,
        eal_valt double, eal_valb double, eal_valp double, eal_valpe double, eal_vala double,
        alr_valb double, alr_valp double, alr_vala double, alr_npctl double, alr_vra_npctl double,
        sovi_score double, sovi_ratng string, sovi_spctl double, resl_score double,
        resl_ratng string, resl_spctl double, resl_value double, crf_value double"""
    hazards = "avln cfld cwav drgt erqk hail hwav hrcn istm lnds ltng ifld swnd trnd tsun vlcn wfir wntw".split()
    with_crops = "cwav drgt hail hwav hrcn ifld swnd trnd wfir wntw".split()
    crops_only = ["drgt"]
    measures = """evnts afreq exp_area expb expp exppe expa expt hlrb hlrp hlra hlrr ealb ealp ealpe
        eala ealt eals ealr alrb alrp alra alr_npctl riskv risks riskr""".split()
    crops = ("expa", "hlra", "eala", "alra")
    people = ("expb", "expp", "exppe", "hlrb", "hlrp", "ealb", "ealp", "ealpe", "alrb", "alrp")
    ratings = ("hlrr", "ealr", "riskr")
    columns = [head]
    for hazard in hazards:
        for measure in measures:
            if (measure in crops and hazard not in with_crops) or (measure in people and hazard in crops_only):
                continue
            columns.append(f"{hazard}_{measure} {'string' if measure in ratings else 'double'}")
    return _schema(", ".join([*columns, "nri_ver string, shape_area double, shape_length double"]))


NRI_COUNTIES = _risk_index()
# The columns without which the scores can't be cleaned.
NRI_REQUIRED = ("nri_id", "state", "statefips", "county", "countyfips", "stcofips", "risk_score", "eal_score", "sovi_score", "resl_score")

ACS_TABLES = {
    "b01001": _acs("b01001", 49),
    "b15003": _acs("b15003", 25),
    "b23025": _acs("b23025", 7),
    "b19013": _acs("b19013", 1, annotated=False),
    "b25077": _acs("b25077", 1, annotated=False),
}

CROSSWALK = _schema("zip string, county string, year string, tot_ratio string, top_match string")
HAZARD_TYPE_MAP = _schema("event_type string, hazard_group string, hazard_subgroup string")
CENTROIDS = _schema("county_fips string, county_name string, state string, lat double, lon double")

BRONZE = {
    "disaster_declarations": DECLARATIONS,
    "housing_assistance_owners": OWNERS,
    "housing_assistance_renters": RENTERS,
    "nri_counties": NRI_COUNTIES,
    **{f"acs5_2022_{name}": schema for name, schema in ACS_TABLES.items()},
}

# Data sets of which not every declared column must be there.
BRONZE_REQUIRED = {"nri_counties": NRI_REQUIRED}

# Columns a raw storm-event file must have.
EVENT_REQUIRED = (
    "event_id",
    "episode_id",
    "state",
    "state_fips",
    "cz_fips",
    "event_type",
    "begin_date_time",
    "end_date_time",
    "year",
)

# Columns of the cleaned tables and marts, in table order.
CLAIMS = {
    "id": "string",
    "tenure": "string",
    "disasternumber": "bigint",
    "state": "string",
    "county": "string",
    "city": "string",
    "zipcode": "string",
    "validregistrations": "bigint",
    "approvedforfemaassistance": "bigint",
    "totalapprovedihpamount": "double",
    "repairreplaceamount": "double",
    "rentalamount": "double",
    "otherneedsamount": "double",
    "totalinspected": "bigint",
    "totaldamage": "double",
}

# Claim measure -> mart column.
CLAIM_MEASURES = {
    "validregistrations": "fema_valid_registrations",
    "totaldamage": "fema_total_damage",
    "totalapprovedihpamount": "fema_total_approved_ihp_amount",
    "repairreplaceamount": "fema_repair_replace_amount",
    "rentalamount": "fema_rental_amount",
    "otherneedsamount": "fema_other_needs_amount",
    "totalinspected": "fema_total_inspected",
}

CENSUS_MEASURES = (
    "population_total",
    "median_household_income",
    "median_home_value",
    "employment_universe_total",
    "in_labor_force",
    "unemployed",
    "education_universe_total",
    "high_school_grad",
    "bachelors",
    "graduate_degree",
)

# Score of the cleaned table -> mart column.
NRI_SCORES = {
    "risk_score": "nri_risk_score",
    "eal_score": "nri_eal_score",
    "sovi_score": "nri_sovi_score",
    "resl_score": "nri_resl_score",
}

EVENT_FEATURES = (
    "noaa_event_count",
    "noaa_total_fatalities",
    "noaa_total_injuries",
    "noaa_avg_property_damage",
)

CLAIM_FEATURES = (
    "fema_valid_registrations",
    "fema_total_damage",
    "fema_total_approved_ihp_amount",
    "fema_declaration_count",
    "fema_repair_replace_amount",
    "fema_rental_amount",
    "fema_other_needs_amount",
    "fema_total_inspected",
)

FEATURE_MART_COLUMNS = (
    "county_fips",
    *EVENT_FEATURES,
    *CLAIM_FEATURES,
    *CENSUS_MEASURES,
    "census_acs_year",
    *NRI_SCORES.values(),
    "year",
)

SUMMARY_COLUMNS = (
    "county_fips",
    "hazard_type",
    "hazard_category",
    "event_count",
    "total_fatalities",
    "total_injuries",
    "avg_property_damage",
    "year",
)

COUNTY_RISK_SCORES = _schema(
    """county_fips string, year int, risk_score double, risk_bucket string, model_name string,
    model_version string, scored_at timestamp, top_features_json string, shap_summary_json string"""
)
