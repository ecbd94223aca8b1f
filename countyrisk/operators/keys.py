"""Operators on the county key of a frame.

Joins with a reference are left to the adaptive planner, which broadcasts by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fips

_REF = "__reference_key"


def standardize(df: DataFrame, column: str = "county_fips") -> DataFrame:
    return df.withColumn(column, fips.standard_fips(column)) if column in df.columns else df


def keep_sane(df: DataFrame, column: str = "county_fips") -> DataFrame:
    return df.filter(fips.sane_condition(column)) if column in df.columns else df


def split_by_sanity(df: DataFrame, column: str = "county_fips") -> tuple[DataFrame, DataFrame]:
    """Rows with a sane key and the others, NULL keys included, by two filters."""
    sane = fips.is_sane_fips(column)
    return df.filter(sane), df.filter(~sane)


def trimmed_key(column: str | Column) -> Column:
    return F.trim((F.col(column) if isinstance(column, str) else column).cast("string"))


def key_set(df: DataFrame, column: str = "county_fips", out: str = _REF) -> DataFrame:
    """Distinct keys, blanks around them left off; NULL is no key."""
    return df.select(trimmed_key(column).alias(out)).filter(F.col(out).isNotNull()).distinct()


def keep_canonical(df: DataFrame, reference: DataFrame, column: str = "county_fips") -> DataFrame:
    """Rows whose key is in the reference (semi join)."""
    if column not in df.columns or "county_fips" not in reference.columns:
        return df
    keys = key_set(reference)
    return df.join(keys, trimmed_key(column) == F.col(_REF), "left_semi")


def not_canonical(df: DataFrame, reference: DataFrame, column: str = "county_fips") -> DataFrame:
    """Rows whose key is not in the reference (anti join)."""
    keys = key_set(reference)
    return df.join(keys, trimmed_key(column) == F.col(_REF), "left_anti")


def add_centroids(
    df: DataFrame, centroids: DataFrame, key: str = "county_fips"
) -> DataFrame:
    """Latitude, longitude, name and state of each row's county (left join)."""
    points = centroids.select(
        F.lpad(F.col("county_fips").cast("string"), 5, "0").alias("__point"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
        "county_name",
        "state",
    )
    padded = F.lpad(F.col(key).cast("string"), 5, "0")
    return df.join(points, padded == F.col("__point"), "left").drop("__point")
