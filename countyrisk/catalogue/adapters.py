"""Hazard-shaped raw frames as projections of the TPC-H-like tables.

Every expression is plain SQL that Spark and DuckDB read alike, so the same text
makes the Spark frame and the oracle's CTE. All columns are strings under messy
header names, like the files the cleaning jobs expect. Nothing is filtered away.

One disaster and one ZIP hold a third of all claims, as a large storm would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.names import snake_case

FIRST_YEAR, LAST_YEAR = 1996, 2000
HOT_DISASTER, HOT_PART = 8, 7


def _text(expr: str) -> str:
    return f"cast({expr} as string)"


def _floor(expr: str, by: int) -> str:
    return f"cast(floor({expr} / {by}) as bigint)"


def _state(index: str) -> str:
    """58 state codes: 0 to 56 and 72."""
    return f"(CASE WHEN {index} = 57 THEN 72 ELSE {index} END)"


def _letter(code: str) -> str:
    return f"chr(cast(65 + {code} as int))"


def _place(code: str) -> str:
    """Counties 5 and 6 share a name once the kind of area is dropped."""
    return f"(CASE WHEN {code} = 6 THEN 'Lake F City' ELSE concat('Lake ', {_letter(code)}, ' County') END)"


def _state_name(state: str) -> str:
    return f"(CASE WHEN {state} = 9 THEN 'Connecticut' ELSE concat('State ', {_text(state)}) END)"


def _disaster(order: str) -> str:
    return f"(CASE WHEN {order} % 3 = 0 THEN {HOT_DISASTER} ELSE {_floor(order, 30)} END)"


def _short_date(ts: str) -> str:
    months = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
    return (
        f"concat(lpad({_text(f'day({ts})')}, 2, '0'), '-', "
        f"substr('{months}', cast(3 * month({ts}) - 2 as int), 3), '-', "
        f"substr({_text(f'year({ts})')}, 3, 2), ' 14:45:00')"
    )


def _iso_date(ts: str) -> str:
    return f"concat(substr({_text(ts)}, 1, 10), 'T00:00:00.000Z')"


_EVENT_STATE = "((l_suppkey * 7 + l_orderkey) % 58)"
_ZONE = "(l_partkey % 30)"
_AMOUNT = _text("l_quantity")

_CUSTOMER_STATE = _state("(c_custkey % 58)")
_CUSTOMER_COUNTY = f"((5 * {_floor('c_custkey', 58)} + c_custkey % 58) % 23)"
# Some rows of the smaller census tables belong to the next county, so joins miss.
_CUSTOMER_SHIFTED = f"(({_CUSTOMER_COUNTY} + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END) % 23)"
_ORDER_STATE = _state("(o_custkey % 58)")
_ORDER_COUNTY = f"((5 * {_floor('o_custkey', 58)} + o_custkey % 58) % 23)"
_PART_STATE = _state("(p_partkey % 58)")
_PART_COUNTY = f"((5 * {_floor('p_partkey', 58)} + p_partkey % 58) % 23)"

_CLAIM_PART = f"(CASE WHEN l_orderkey % 3 = 0 THEN {HOT_PART} ELSE l_partkey END)"
_CLAIM_ZIP = f"(({_CLAIM_PART} * 37) % 100000)"

_EVENTS = {
    "EVENT_ID": _text("l_orderkey * 10 + l_linenumber"),
    "EPISODE_ID": _text("l_orderkey"),
    "STATE": f"CASE WHEN l_linenumber = 7 AND l_partkey % 11 = 0 THEN '  ' ELSE concat('State ', {_text(_EVENT_STATE)}) END",
    "State Fips": f"CASE WHEN {_EVENT_STATE} = 57 THEN '99' ELSE {_text(_EVENT_STATE)} END",
    "CZ_TYPE": "CASE WHEN l_partkey % 10 = 0 THEN 'Z' WHEN l_partkey % 10 = 1 THEN ' c ' WHEN l_partkey % 97 = 5 THEN NULL ELSE 'C' END",
    "CZ_FIPS": f"CASE WHEN l_partkey % 211 = 3 THEN '' ELSE {_text(_ZONE)} END",
    "CZ_NAME": (
        f"CASE WHEN {_ZONE} <= 22 THEN concat('LAKE ', {_letter(_ZONE)}, ' (C)') "
        f"WHEN l_linenumber <= 3 THEN concat('Lake ', {_letter(f'({_ZONE} - 20)')}, ' County') "
        f"WHEN l_linenumber <= 5 THEN concat('LAKE', {_letter(f'({_ZONE} - 20)')}, ' (C)') "
        f"WHEN l_linenumber = 6 THEN concat('Nowhere ', {_text(_ZONE)}) ELSE NULL END"
    ),
    "EVENT_TYPE": f"concat('Hazard ', {_text('l_partkey % 40')})",
    "CATEGORY": f"CASE WHEN cast(l_quantity as int) % 5 = 0 THEN NULL ELSE concat('C', {_text('l_linenumber')}) END",
    "YEAR": f"CASE WHEN l_orderkey % 101 = 0 THEN 'n/a' WHEN l_orderkey % 97 = 0 THEN concat('FY', {_text('year(l_shipdate)')}) ELSE {_text('year(l_shipdate)')} END",
    "BEGIN_DATE_TIME": f"CASE WHEN l_partkey % 13 = 0 THEN 'soon' WHEN l_partkey % 2 = 0 THEN {_short_date('l_shipdate')} ELSE {_text('l_shipdate')} END",
    "END_DATE_TIME": f"CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE {_short_date('(l_shipdate + INTERVAL 20 DAY)')} END",
    "BEGIN_DAY": _text("day(l_shipdate)"),
    "INJURIES_DIRECT": f"CASE WHEN l_linenumber = 4 THEN 'x' ELSE {_text('l_orderkey % 4')} END",
    "INJURIES_INDIRECT": _text("l_partkey % 2"),
    "DEATHS_DIRECT": f"CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE {_text('l_linenumber % 3')} END",
    "DEATHS_INDIRECT": f"CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE {_text('l_suppkey % 2')} END",
    "DAMAGE_PROPERTY": (
        f"CASE l_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN {_AMOUNT} WHEN 3 THEN concat({_AMOUNT}, 'K') "
        f"WHEN 4 THEN concat({_AMOUNT}, 'm') WHEN 5 THEN concat('$', {_AMOUNT}, 'K') WHEN 6 THEN 'abc' "
        f"ELSE concat(' ', {_AMOUNT}, 'K ') END"
    ),
    "DAMAGE_CROPS": f"concat({_text('l_linenumber')}, 'K')",
    "MAGNITUDE": f"CASE WHEN l_linenumber = 2 THEN 'EF1' ELSE {_text('l_linenumber')} END",
    "BEGIN_LAT": _text("l_discount"),
    "RUN_DT": "CASE WHEN l_discount < 0.05 THEN '2024-01-01' ELSE '2024-02-01' END",
}

_DECLARATIONS = {
    "femaDeclarationString": f"concat('DR-', {_text(_disaster('o_orderkey'))})",
    "disasterNumber": _text(_disaster("o_orderkey")),
    "state": f"concat(' S', {_text(_disaster('o_orderkey') + ' % 50')}, ' ')",
    "declarationType": "CASE WHEN o_orderkey % 4 = 0 THEN 'EM' ELSE 'DR' END",
    "declarationDate": _iso_date("o_orderdate"),
    "fyDeclared": "CASE WHEN o_orderkey % 83 = 0 THEN '20240101123' ELSE " + _text(
        f"(1995 + {_disaster('o_orderkey')} % 7 + CASE WHEN {_disaster('o_orderkey')} % 9 = 0 AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END)"
    ) + " END",
    "incidentType": "o_orderpriority",
    "ihProgramDeclared": f"CASE WHEN o_orderkey % 12 = 0 THEN 'yes' ELSE {_text('o_orderkey % 2')} END",
    "incidentBeginDate": "CASE WHEN o_orderkey % 6 = 0 THEN 'unknown' ELSE substr(cast(o_orderdate as string), 1, 10) END",
    "incidentEndDate": f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_iso_date('(o_orderdate + INTERVAL 9 DAY)')} END",
    "fipsStateCode": f"CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE {_text(_ORDER_STATE)} END",
    "fipsCountyCode": _text(_ORDER_COUNTY),
    "id": f"concat('d', {_text('CASE WHEN o_orderkey % 10 = 9 THEN o_orderkey - 1 ELSE o_orderkey END')})",
    "run_dt": "CASE WHEN o_orderstatus = 'F' THEN '2024-01-01' ELSE '2024-02-01' END",
}

_CLAIM = {
    "disasterNumber": _text(_disaster("l_orderkey")),
    "state": f"concat('S', {_text(_disaster('l_orderkey') + ' % 50')})",
    "county": f"concat('Lake ', {_letter('(l_partkey % 23)')}, ' (County)')",
    "city": f"concat('City ', {_text('l_partkey % 100')})",
    "zipCode": (
        f"CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 51 = 0 THEN 'none' "
        f"WHEN l_partkey % 49 = 0 THEN concat('ZIP ', lpad({_text(_CLAIM_ZIP)}, 5, '0'), '-0001') ELSE {_text(_CLAIM_ZIP)} END"
    ),
    "validRegistrations": f"CASE WHEN l_partkey % 31 = 0 THEN 'x' ELSE {_text('cast(l_quantity as int)')} END",
    "totalInspected": _text("l_linenumber"),
    "approvedForFemaAssistance": _text("l_linenumber % 4"),
    "totalApprovedIhpAmount": _text("cast(floor(l_extendedprice / 2) as bigint)"),
    "repairReplaceAmount": _text("cast(floor(l_extendedprice / 4) as bigint)"),
    "rentalAmount": f"CASE WHEN l_linenumber = 3 THEN NULL ELSE {_text('cast(floor(l_extendedprice / 8) as bigint)')} END",
    "otherNeedsAmount": _text("cast(floor(l_extendedprice / 16) as bigint)"),
    "id": f"concat('c', {_text('l_orderkey * 10 + l_linenumber')})",
    "run_dt": "CASE WHEN l_discount < 0.05 THEN '2024-01-01' ELSE '2024-02-01' END",
}
_OWNERS = {**_CLAIM, "totalDamage": _text("cast(floor(l_extendedprice) as bigint)")}

_NRI = {
    "NRI_ID": f"concat('N', {_text('c_custkey')})",
    "STATE": _state_name(_CUSTOMER_STATE),
    "STATEFIPS": _text(_CUSTOMER_STATE),
    "COUNTY": (
        f"CASE WHEN {_CUSTOMER_STATE} = 9 AND c_custkey % 5 = 0 THEN concat({_place(_CUSTOMER_COUNTY)}, ', Connecticut, USA') "
        f"WHEN {_CUSTOMER_STATE} = 9 AND c_custkey % 5 = 1 THEN concat({_place(_CUSTOMER_COUNTY)}, ', Conneccticut, USA') "
        f"WHEN {_CUSTOMER_STATE} = 9 AND c_custkey % 2 = 0 THEN concat({_place(_CUSTOMER_COUNTY)}, ', Connecticut') "
        f"WHEN {_CUSTOMER_STATE} = 9 THEN concat({_place(_CUSTOMER_COUNTY)}, ' Connecticut') "
        f"WHEN c_custkey % 61 = 0 THEN '' ELSE {_place(_CUSTOMER_COUNTY)} END"
    ),
    "COUNTYFIPS": _text(_CUSTOMER_COUNTY),
    "STCOFIPS": f"CASE WHEN c_custkey % 41 = 0 THEN '' ELSE {_text(f'{_CUSTOMER_STATE} * 1000 + {_CUSTOMER_COUNTY}')} END",
    "RISK_SCORE": f"CASE WHEN c_acctbal < 0 THEN '' WHEN c_custkey % 53 = 0 THEN 'n/a' ELSE {_text('c_acctbal')} END",
    "EAL_SCORE": _text("c_custkey % 100"),
    "SOVI_SCORE": f"CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE {_text('c_custkey % 90')} END",
    "RESL_SCORE": _text("c_custkey % 80"),
}


def _acs(cells: dict[str, str], county: str) -> dict[str, str]:
    name = f"concat({_place(county)}, ', ', {_state_name(_CUSTOMER_STATE)})"
    return {
        "NAME": name,
        **{cell.upper(): expr for cell, expr in cells.items()},
        "state": _text(_CUSTOMER_STATE),
        "county": _text(county),
    }


_B01001 = {
    **_acs({"b01001_001e": f"CASE WHEN c_custkey % 23 = 0 THEN 'null' ELSE {_text('1000 + c_custkey % 5000')} END"}, _CUSTOMER_COUNTY),
    "ACS_YEAR": _text("2018 + c_custkey % 5"),
}
_B19013 = _acs({"b19013_001e": _text("30000 + c_custkey % 700")}, _CUSTOMER_SHIFTED)
_B25077 = _acs({"b25077_001e": _text("90000 + c_custkey % 900")}, _CUSTOMER_SHIFTED)
_B23025 = _acs(
    {
        "b23025_001e": _text("900 + c_custkey % 50"),
        "b23025_002e": _text("500 + c_custkey % 50"),
        "b23025_005e": _text("c_custkey % 50"),
    },
    _CUSTOMER_COUNTY,
)
_B15003 = _acs(
    {
        "b15003_001e": _text("800 + c_custkey % 60"),
        "b15003_017e": _text("300 + c_custkey % 60"),
        "b15003_022e": _text("200 + c_custkey % 60"),
        "b15003_025e": _text("100 + c_custkey % 60"),
    },
    _CUSTOMER_SHIFTED,
)

_CROSSWALK = {
    "zip": _text("(p_partkey * 37) % 100000"),
    "county": _text(f"{_PART_STATE} * 1000 + {_PART_COUNTY}"),
    "year": _text("xwalk_year"),
    "tot_ratio": "CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '1.0' WHEN 2 THEN '0.5' WHEN 3 THEN '0.25' ELSE '0.75' END",
    "top_match": "CASE p_size % 4 WHEN 0 THEN 'False' WHEN 1 THEN 'True' WHEN 2 THEN '1' ELSE 't' END",
}

_TYPE_MAP = {
    "event_type": f"CASE WHEN p_partkey % 40 = 39 THEN 'Hazard unused' ELSE concat('Hazard ', {_text('p_partkey % 40')}) END",
    "hazard_group": f"concat('Group ', {_text('p_partkey % 40 % 6')})",
    "hazard_subgroup": f"concat('Subgroup \"', {_text('p_partkey % 40 % 12')}, '\", mixed')",
}

_CENTROIDS = {
    "county_fips": _text(f"{_CUSTOMER_STATE} * 1000 + {_CUSTOMER_COUNTY}"),
    "county_name": _place(_CUSTOMER_COUNTY),
    "state": _state_name(_CUSTOMER_STATE),
    "lat": f"CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE {_text('25 + c_custkey % 20')} END",
    "lon": _text("0 - 70 - c_custkey % 50"),
}

# Raw frame -> (table, columns, row predicate that belongs to the data set).
RAW = {
    "events": ("lineitem", _EVENTS, None),
    "declarations": ("orders", _DECLARATIONS, None),
    "owners": ("lineitem", _OWNERS, "l_returnflag <> 'R'"),
    "renters": ("lineitem", _CLAIM, "l_returnflag = 'R'"),
    "nri": ("customer", _NRI, None),
    "b01001": ("customer", _B01001, None),
    "b19013": ("customer", _B19013, None),
    "b25077": ("customer", _B25077, None),
    "b23025": ("customer", _B23025, None),
    "b15003": ("customer", _B15003, None),
    "crosswalk": ("part", _CROSSWALK, None),
    "type_map": ("part", _TYPE_MAP, None),
    "centroids": ("customer", _CENTROIDS, None),
}
DISTINCT = ("type_map",)
YEARS = (1995, 2001)


def columns(name: str) -> list[str]:
    """Normalised column names of a raw frame."""
    return [snake_case(c) for c in RAW[name][1]]


def raw_frame(rows: DataFrame, name: str) -> DataFrame:
    """The raw frame made from the rows of its table."""
    _, exprs, predicate = RAW[name]
    if predicate:
        rows = rows.filter(predicate)
    if name == "crosswalk":
        rows = rows.selectExpr("*", f"explode(sequence({YEARS[0]}, {YEARS[1]})) AS xwalk_year")
    shaped = rows.selectExpr(*[f"{e} AS `{c}`" for c, e in exprs.items()])
    return shaped.distinct() if name in DISTINCT else shaped


def raw_sql(name: str) -> str:
    """The same frame for DuckDB, under the normalised names."""
    table, exprs, predicate = RAW[name]
    source = table
    if name == "crosswalk":
        source = f"(SELECT *, unnest(generate_series({YEARS[0]}, {YEARS[1]})) AS xwalk_year FROM part)"
    distinct = "DISTINCT " if name in DISTINCT else ""
    where = f" WHERE {predicate}" if predicate else ""
    return f"SELECT {distinct}" + ", ".join(f"{e} AS {snake_case(c)}" for c, e in exprs.items()) + f" FROM {source}{where}"
