"""Quality checks as data: each check is a row with a failure count.

Row checks of one table share a single aggregation. Key and set checks have their
own frame. :func:`run_checks` brings all of them to ``name, severity, failures,
passed``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import keys

BLOCKING, WARNING = "blocking", "warning"
RESULT_SCHEMA = "suite string, name string, severity string, description string, failures bigint, passed boolean"


# --- row checks: aggregate expressions over one table -------------------------


def not_empty() -> Column:
    """0 when the table has a row, else 1."""
    return F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint")


def count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("bigint")


def any_null(columns: Iterable[str]) -> Column:
    return count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def any_negative(columns: Iterable[str]) -> Column:
    return count_if(is_negative(columns))


def is_negative(columns: Iterable[str]) -> Column:
    """A NULL metric is not a negative one."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns])


def outside_window(first: int, last: int, column: str = "year") -> Column:
    """1 if any row lies outside, else 0."""
    outside = F.coalesce(~F.col(column).between(first, last), F.lit(False))
    return F.least(count_if(outside), F.lit(1)).cast("bigint")


def year_complete(column: str = "year") -> Column:
    """1 if the table is empty or any year is NULL."""
    bad = (F.count("*") == 0) | (F.count_if(F.col(column).isNull()) > 0)
    return F.when(bad, 1).otherwise(0).cast("bigint")


def pct(condition: Column) -> Column:
    """Percentage of rows that meet the condition; NULL on an empty group."""
    return 100.0 * F.count_if(condition) / F.nullif(F.count("*"), F.lit(0))


def null_pct(column: str) -> Column:
    return pct(F.col(column).isNull())


def null_pct_above(columns: Iterable[str], limit: float = 5.0) -> Column:
    """1 if the table is empty or a column has more than ``limit`` percent NULLs."""
    over = reduce(lambda a, b: a | b, [null_pct(c) > limit for c in columns])
    return F.when((F.count("*") == 0) | over, 1).otherwise(0).cast("bigint")


# --- key and set checks: one-row frames with a ``failures`` column --------------


def duplicate_groups(df: DataFrame, grain: Sequence[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*grain).agg(F.count("*").alias(out)).filter(F.col(out) > 1)


def unique(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    return duplicate_groups(df, grain).agg(F.count("*").alias("failures"))


def referential(df: DataFrame, reference: DataFrame, column: str = "county_fips") -> DataFrame:
    """Number of distinct keys that the reference does not have."""
    distinct = df.select(column).distinct()
    return keys.not_canonical(distinct, keys.keep_sane(reference), column).agg(F.count("*").alias("failures"))


def covers(df: DataFrame, universe: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Number of universe rows that the table does not have."""
    return universe.select(*grain).join(df.select(*grain), list(grain), "left_anti").agg(F.count("*").alias("failures"))


def unmapped(df: DataFrame, reference: DataFrame, column: str, reference_column: str) -> DataFrame:
    """Distinct non-NULL values that the reference does not have."""
    known = reference.select(F.col(reference_column).alias(column))
    return df.filter(F.col(column).isNotNull()).select(column).distinct().join(known, column, "left_anti")


def row_counts_equal(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Both row counts, as a row only where they differ."""
    other = right.agg(F.count("*")).scalar()
    counts = left.agg(F.count("*").alias(names[0])).withColumn(names[1], other)
    return counts.filter(F.col(names[0]) != F.col(names[1]))


def required_columns(df: DataFrame, required: Sequence[str]) -> int:
    """Number of required names that the table lacks, without regard to case."""
    present = {c.lower() for c in df.columns}
    return sum(r.lower() not in present for r in required)


def missing_headers(spark: SparkSession, path: str, required: Sequence[str], glob: str = "{*.csv,*.csv.gz}") -> DataFrame:
    """``path, missing``: the required names that a CSV file's header lacks, for each file that lacks any.

    The header is the first line of the file's first block, read in the task that has it; names are compared
    without regard to case, quotes and blanks around them."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    heads = lines.filter("_metadata.file_block_start = 0").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.first("value").alias("head"))
    cells = F.transform(F.split("head", ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '^\ufeff|"', ""))))
    wanted = F.array(*[F.lit(r.lower()) for r in required])
    return heads.select("path", F.array_except(wanted, cells).alias("missing")).filter(F.size("missing") > 0)


def violations(df: DataFrame, columns: Iterable[str], limit: int = 50, order: Sequence[str] = ()) -> DataFrame:
    """Sample of rows with a negative metric."""
    found = df.filter(is_negative(columns))
    return (found.orderBy(*order) if order else found).limit(limit)


def match_rate(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct keys of both sides and the share of the left that the right has."""
    ids = left.filter(F.col(column).isNotNull()).select(column).distinct()
    known = right.filter(F.col(column).isNotNull()).select(column).distinct().withColumn("__hit", F.lit(1))
    matched = ids.join(known.select(column, "__hit"), column, "left").agg(
        F.count("*").alias("left_cnt"), F.count("__hit").alias("matched_cnt")
    )
    return matched.select(
        "left_cnt",
        known.agg(F.count("*")).scalar().alias("right_cnt"),
        "matched_cnt",
        (F.col("left_cnt") - F.col("matched_cnt")).alias("unmatched_cnt"),
        F.when(F.col("left_cnt") == 0, 0.0)
        .otherwise(F.col("matched_cnt").cast("double") / F.col("left_cnt"))
        .alias("match_rate"),
    )


def share_in_reference(df: DataFrame, reference: DataFrame, column: str = "county_fips") -> DataFrame:
    """Rows, rows whose key is in the reference, and their share (one row).

    The rows are counted per key first; only those counts meet the reference.
    """
    per_key = df.groupBy(keys.trimmed_key(column).alias("__key")).agg(F.count("*").alias("__n"))
    known = keys.key_set(reference, out="__key").withColumn("__hit", F.lit(1))
    counted = per_key.join(known, "__key", "left").agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("__hit") == 1, F.col("__n"))), F.lit(0)).alias("matched_rows"),
    )
    return counted.withColumn(
        "match_rate",
        F.when(F.col("total_rows") == 0, 0.0).otherwise(F.col("matched_rows").cast("double") / F.col("total_rows")),
    )


def null_rates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Share of NULL or blank values per column, one pass, one row."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.limit(0).agg(F.lit("no_cols").alias("note"))
    return df.agg(
        *[
            F.avg(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1.0).otherwise(0.0)).alias(
                f"{c}_null_rate"
            )
            for c in present
        ]
    )


# --- suites -----------------------------------------------------------------------


@dataclass(frozen=True)
class Unique:
    """Groups of the suite's table with more than one row."""

    grain: Sequence[str]


@dataclass(frozen=True)
class Referential:
    """Distinct keys of the suite's table that the reference does not have; a NULL key is one."""

    reference: DataFrame
    column: str = "county_fips"


@dataclass(frozen=True)
class Covers:
    """Rows of a universe that the suite's table does not have; a NULL in the grain is never had."""

    universe: DataFrame
    grain: Sequence[str]


KeyCheck = Unique | Referential | Covers


@dataclass(frozen=True)
class Check:
    """A named check.

    ``test`` is an aggregate column (a row check on the suite's table), a key check, or a function
    without arguments that gives a one-row frame with ``failures`` or an int. Key checks and a few row
    checks of a suite share one scan of its table.
    """

    name: str
    test: Column | KeyCheck | Callable[[], DataFrame | int]
    severity: str = BLOCKING
    description: str = ""


@dataclass(frozen=True)
class Suite:
    name: str
    table: DataFrame | None
    checks: Sequence[Check] = field(default_factory=tuple)


_CHECK, _KEY, _MINE, _THEIRS = "__check", "__key", "__mine", "__theirs"
_ROWS = -1


def _entry(check: int, key: Sequence[Column], mine: int) -> Column:
    parts = F.array(*[k.cast("string") for k in key]) if key else F.lit(None).cast("array<string>")
    named = {_CHECK: F.lit(check), _KEY: parts, _MINE: F.lit(mine), _THEIRS: F.lit(1 - mine)}
    return F.struct(*[value.alias(name) for name, value in named.items()])


def _own_key(test: KeyCheck) -> list[Column]:
    return [keys.trimmed_key(test.column)] if isinstance(test, Referential) else [F.col(c) for c in test.grain]


def _other_side(check: int, test: KeyCheck) -> DataFrame | None:
    """Entries of the table that a check compares with."""
    if isinstance(test, Referential):
        known = keys.keep_sane(test.reference).select(keys.trimmed_key("county_fips").alias("k")).filter("k IS NOT NULL")
        return known.select(_entry(check, [F.col("k")], 0).alias("e"))
    if isinstance(test, Covers):
        return test.universe.select(_entry(check, [F.col(c) for c in test.grain], 0).alias("e"))
    return None


def _key_failures(check: int, test: KeyCheck) -> Column:
    own = F.col(_CHECK) == check
    if isinstance(test, Unique):
        return F.count_if(own & (F.col(_MINE) > 1))
    if isinstance(test, Referential):
        return F.count_if(own & (F.col(_MINE) > 0) & (F.col(_THEIRS) == 0))
    lost = (F.col(_MINE) == 0) | F.exists(_KEY, lambda part: part.isNull())
    return F.coalesce(F.sum(F.when(own & lost, F.col(_THEIRS))), F.lit(0))


def _fused_frame(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Row and key checks of a table in one pass over it, one output row per check.

    Each row stands once for the row checks and once for each key check, under that check's key; rows of
    references and universes stand beside them under the same keys. One aggregation by check and
    key, partial in each task, gives all: the rows of a key on either side, and the row checks."""
    rows = [c for c in checks if isinstance(c.test, Column)]
    by_key = [(k, c.test) for k, c in enumerate(checks) if not isinstance(c.test, Column)]
    entries = [_entry(_ROWS, [], 1), *[_entry(k, _own_key(test), 1) for k, test in by_key]]
    expanded = table.withColumn("__e", F.explode(F.array(*entries)))
    for k, test in by_key:
        other = _other_side(k, test)
        if other is not None:
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields]
            expanded = expanded.unionByName(other.select(*empty, F.col("e").alias("__e")))
    expanded = expanded.withColumns({c: F.col(f"__e.{c}") for c in (_CHECK, _KEY, _MINE, _THEIRS)})
    values = {c.name: c.test.cast("bigint").alias(f"__row{i}") for i, c in enumerate(rows)}
    grouped = expanded.groupBy(_CHECK, _KEY).agg(F.sum(_MINE).alias(_MINE), F.sum(_THEIRS).alias(_THEIRS), *values.values())
    found = {c.name: F.max(F.when(F.col(_CHECK) == _ROWS, F.col(f"__row{i}"))) for i, c in enumerate(rows)}
    found |= {checks[k].name: _key_failures(k, test).cast("bigint") for k, test in by_key}
    one = grouped.agg(*[column.alias(f"c{i}") for i, column in enumerate(found.values())])
    # a table without rows has no group for the row checks: their values over nothing, which reads nothing
    without = {c.name: table.limit(0).agg(c.test.cast("bigint")).scalar() for c in rows}
    results = [
        F.struct(F.lit(name).alias("name"), F.coalesce(F.col(f"c{i}"), without.get(name, F.lit(None))).alias("failures"))
        for i, name in enumerate(found)
    ]
    return one.select(F.explode(F.array(*results)).alias("r")).select("r.name", "r.failures")


def _row_check_frame(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Row checks of a table in one aggregation, one output row per check."""
    aggregated = table.agg(*[c.test.cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[F.struct(F.lit(c.name).alias("name"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
    )
    return aggregated.select(F.explode(rows).alias("r")).select("r.name", "r.failures")


# Row checks that may ride along with the keys: each is a value more in the state of every key.
NARROW = 8


def _table_checks(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Row and key checks of a table. Row checks alone need no expansion; many of them get a scan of their
    own columns instead of widening the state of every key."""
    rows = [c for c in checks if isinstance(c.test, Column)]
    by_key = [c for c in checks if not isinstance(c.test, Column)]
    if not by_key:
        return _row_check_frame(table, rows)
    if len(rows) <= NARROW:
        return _fused_frame(table, checks)
    return _row_check_frame(table, rows).unionByName(_fused_frame(table, by_key))


def _on_table(check: Check) -> bool:
    return isinstance(check.test, Column | KeyCheck)


def _failures(spark: SparkSession, suite: Suite, check: Check) -> DataFrame:
    """``name, failures`` of one check; -1 if it cannot be planned."""
    try:
        if _on_table(check):
            return _table_checks(suite.table, [check])
        result = check.test()
        if isinstance(result, DataFrame):
            return result.select(F.lit(check.name).alias("name"), F.col("failures").try_cast("bigint").alias("failures"))
        return spark.range(1).select(F.lit(check.name).alias("name"), F.lit(result).cast("bigint").alias("failures"))
    except PySparkException:
        return spark.range(1).select(F.lit(check.name).alias("name"), F.lit(-1).cast("bigint").alias("failures"))


def check_frame(spark: SparkSession, suite: Suite) -> DataFrame:
    """Results of a suite as a lazy frame. Only a count of 0 passes."""
    shared = [c for c in suite.checks if _on_table(c)]
    others = [c for c in suite.checks if not _on_table(c)]
    frames = []
    if shared:
        try:
            frames.append(_table_checks(suite.table, shared))
        except PySparkException:
            frames += [_failures(spark, suite, c) for c in shared]
    frames += [_failures(spark, suite, c) for c in others]
    if not frames:
        return spark.createDataFrame([], RESULT_SCHEMA)
    found = reduce(DataFrame.unionByName, frames)
    spec = F.create_map(
        *[
            item
            for c in suite.checks
            for item in (F.lit(c.name), F.struct(F.lit(c.severity).alias("severity"), F.lit(c.description).alias("description")))
        ]
    )
    return found.select(
        F.lit(suite.name).alias("suite"),
        "name",
        spec[F.col("name")]["severity"].alias("severity"),
        spec[F.col("name")]["description"].alias("description"),
        F.coalesce("failures", F.lit(-1)).cast("bigint").alias("failures"),
        F.coalesce(F.col("failures") == 0, F.lit(False)).alias("passed"),
    )


def run_checks(spark: SparkSession, suite: Suite) -> DataFrame:
    """Results of a suite, evaluated now and kept as a small frame.

    There is one row per check, so collecting them is bounded by the suite. If the
    suite cannot run as a whole, each check runs alone and a broken one counts -1.
    """
    try:
        rows = check_frame(spark, suite).collect()
    except PySparkException:
        rows = []
        for check in suite.checks:
            try:
                rows += check_frame(spark, Suite(suite.name, suite.table, [check])).collect()
            except PySparkException:
                rows.append((suite.name, check.name, check.severity, check.description, -1, False))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def suite_status(results: DataFrame) -> DataFrame:
    """Per suite: status, whether it blocks, failed checks by severity."""
    failed = ~F.col("passed")
    return (
        results.groupBy("suite")
        .agg(
            F.count_if(failed & (F.col("severity") == BLOCKING)).alias("blocking_failures"),
            F.count_if(failed & (F.col("severity") != BLOCKING)).alias("non_blocking_failures"),
        )
        .select(
            "suite",
            F.when(F.col("blocking_failures") > 0, "fail")
            .when(F.col("non_blocking_failures") > 0, "warn")
            .otherwise("pass")
            .alias("status"),
            (F.col("blocking_failures") > 0).alias("block_downstream"),
            "blocking_failures",
            "non_blocking_failures",
        )
    )


def overall_status(statuses: DataFrame) -> DataFrame:
    """The worst status of all suites and whether any of them blocks (one row)."""
    order = F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0)
    worst = F.coalesce(F.max(order), F.lit(0))
    return statuses.agg(
        F.element_at(F.array(F.lit("pass"), F.lit("warn"), F.lit("fail")), worst + 1).alias("status"),
        F.coalesce(F.bool_or("block_downstream"), F.lit(False)).alias("block_downstream"),
    )


# --- contracts ----------------------------------------------------------------------

NUMERIC_CLASS = {"int": "number", "bigint": "number", "double": "number", "decimal": "number"}


def _type_class(data_type: T.DataType) -> str:
    return "number" if isinstance(data_type, T.NumericType) else data_type.simpleString()


def contract_checks(table: DataFrame, contract: dict) -> list[Check]:
    """Checks generated from a contract: columns, types, NULLs, signs, grain, tolerance."""
    types = {f.name: f.dataType for f in table.schema.fields}
    columns = contract["columns"]
    missing = [c for c in columns if c not in types]
    wrong = [
        c
        for c, rule in columns.items()
        if c in types and _type_class(types[c]) != NUMERIC_CLASS.get(rule["type"], rule["type"])
    ]
    checks = [
        Check("columns_present", lambda: len(missing), description=", ".join(missing)),
        Check("column_types", lambda: len(wrong), description=", ".join(wrong)),
        Check("grain_unique", Unique(contract["grain"])),
    ]
    for c, rule in columns.items():
        if c not in types:
            continue
        if rule.get("required"):
            checks.append(Check(f"{c}__not_null", any_null([c])))
        if rule.get("non_negative"):
            checks.append(Check(f"{c}__non_negative", any_negative([c])))
    for names, limit in contract.get("null_tolerance", []):
        present = [c for c in names if c in types]
        checks += [Check(f"{c}__null_pct", null_pct_above([c], limit), WARNING) for c in present]
    return checks
