"""Typed casts that turn unreadable text into NULL instead of failing the job."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names of the storm reports, three letters each.
MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.trim(c.cast("string")) != "", c)


def blanks_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: blank_to_null(c) for c in columns if c in df.columns})


# What each readable text of a type holds: a digit, or for doubles the n of Infinity and NaN.
NUMBER_MARK = {"int": "[0-9]", "bigint": "[0-9]", "double": "[0-9nN]"}


def try_number(c: Column | str, kind: str) -> Column:
    """``try_cast`` of text. A failed cast to a number costs an exception per row, so blank cells and
    words are told by :data:`NUMBER_MARK` first."""
    text = _col(c)
    return F.when(text.rlike(NUMBER_MARK[kind]), text.try_cast(kind))


def try_casts(df: DataFrame, types: dict[str, Iterable[str]]) -> DataFrame:
    """``{"int": [...], "double": [...]}``: cast the listed columns that exist."""
    texts = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns(
        {
            c: try_number(c, t) if c in texts and t in NUMBER_MARK else F.col(c).try_cast(t)
            for t, columns in types.items()
            for c in columns
            if c in df.columns
        }
    )


def nearest_century(two_digits: Column, year: Column) -> Column:
    """Four-digit year with these last two digits that lies closest to ``year``."""
    return year + F.pmod(two_digits - year + 50, F.lit(100)) - 50


def iso_from_report(text: Column | str, year: Column | str) -> Column:
    """``28-APR-50 14:45:00`` with year 1950 becomes ``1950-04-28 14:45:00``.

    The century comes from ``year``, as the end of an event may fall in the next one.
    NULL for text of another form. The form is told by fixed positions, which is many
    times cheaper per row than a regular expression; the final cast checks the rest.
    """
    text, year = F.upper(F.trim(_col(text))), _col(year).try_cast("int")
    fixed = F.lpad(text, 18, "0")
    at = F.instr(F.lit(MONTHS), F.substring(fixed, 4, 3))
    is_report = (
        (F.substring(fixed, 3, 1) == "-")
        & (F.substring(fixed, 7, 1) == "-")
        & (F.length(text).between(17, 18))
        & (at % 3 == 1)
        & year.isNotNull()
    )
    iso = F.concat_ws(
        "-",
        nearest_century(F.substring(fixed, 8, 2).try_cast("int"), year),
        F.lpad(F.floor((at + 2) / 3).cast("string"), 2, "0"),
        F.concat(F.substring(fixed, 1, 2), F.substring(fixed, 10, 9)),
    )
    return F.when(is_report, iso)


def iso_from_us(text: Column | str) -> Column:
    """``4/28/2010 14:45:00`` becomes ``2010-4-28 14:45:00``; NULL for another form."""
    text = F.trim(_col(text))
    parts = F.split(text, "[/ ]", 4)
    iso = F.concat_ws(" ", F.concat_ws("-", parts[2], parts[0], parts[1]), parts[3])
    return F.when(F.contains(text, F.lit("/")) & (F.size(parts) == 4), iso)


def parse_timestamp(text: Column | str, year: Column | str | None = None) -> Column:
    """ISO text, ``M/D/YYYY HH:MM:SS`` and, with ``year``, ``DD-MON-YY HH:MM:SS``.

    Each form is brought to ISO text and cast once. A cast gives NULL without raising,
    where a failed parse by pattern costs an exception per row.
    """
    text = _col(text).cast("string")
    forms = [iso_from_us(text), text]
    if year is not None:
        forms.insert(0, iso_from_report(text, year))
    return F.coalesce(*forms).try_cast("timestamp")


def try_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """ISO dates, with or without a time part."""
    return df.withColumns({c: F.col(c).try_cast("date") for c in columns if c in df.columns})


def year_from_text(c: Column | str) -> Column:
    """First four-digit run as an int; NULL when there is none."""
    return F.regexp_extract(_col(c).cast("string"), r"(\d{4})", 1).try_cast("int")


def with_year(df: DataFrame, sources: Iterable[str] = ("year", "year_col")) -> DataFrame:
    for source in sources:
        if source in df.columns:
            return df.withColumn("year", year_from_text(source))
    raise ValueError(f"none of the year columns {tuple(sources)} is present")


def require_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows with a NULL in any listed column that exists."""
    tests = [F.col(c).isNotNull() for c in columns if c in df.columns]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def zero_sum(*columns: Column | str) -> Column:
    """Sum with NULL read as zero."""
    return reduce(lambda a, b: a + b, [zero_if_null(c) for c in columns]).cast("bigint")


def default_text(c: Column | str, value: str = "UNKNOWN") -> Column:
    return F.coalesce(_col(c), F.lit(value))


def default_zeros(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Measures absent after an outer join count as zero; other columns stay NULL."""
    return df.fillna(0, subset=[c for c in columns if c in df.columns])
