"""Column profiles of a versioned table, one for each of its folders, merged for the table.

Folders of a committed version never change, so a folder is profiled once: rows, NULLs, least and
greatest value and a distinct-count sketch of each column, in one pass over the new folders. What is stored
merges to the profile of any version, so a run that replaced one year reads that year only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import commits, storage, tables

PROFILE = "folder string, name string, rows long, nulls long, low string, high string, low_number double, high_number double, sketch binary"
# Registers of a sketch, as a power of two: a relative error of about 0.8 percent.
SKETCH_BITS = 14


def profiled(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PROFILE columns of ``rows``, which have a ``folder``."""
    numeric = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)}

    def one(name: str) -> list:
        value = F.col(name)
        text = value.cast("string")
        number = value.cast("double") if name in numeric else F.lit(None).cast("double")
        return [
            F.count_if(value.isNull()).alias("nulls"),
            F.min(text).alias("low"),
            F.max(text).alias("high"),
            F.min(number).alias("low_number"),
            F.max(number).alias("high_number"),
            F.hll_sketch_agg(text, SKETCH_BITS).alias("sketch"),
        ]

    parts = {c: [part.alias(f"{i}_{k}") for k, part in enumerate(one(c))] for i, c in enumerate(columns)}
    wide = rows.groupBy("folder").agg(F.count("*").alias("rows"), *[p for own in parts.values() for p in own])
    names = ["nulls", "low", "high", "low_number", "high_number", "sketch"]
    entries = [
        F.struct(F.lit(c).alias("name"), *[F.col(f"{i}_{k}").alias(n) for k, n in enumerate(names)]) for i, c in enumerate(columns)
    ]
    tall = wide.select("folder", "rows", F.explode(F.array(*entries)).alias("e"))
    return tall.select("folder", F.col("e.name").alias("name"), "rows", *[f"e.{n}" for n in names])


def update_profiles(spark: SparkSession, root: str, store: str, columns: Sequence[str]) -> list[str]:
    """Profile the folders of the current version of the table at ``root`` that ``store`` has no profile of;
    their names."""
    version = commits.latest(spark, root)
    folders = list(version.folders) if version else []
    known = {r.folder for r in stored(spark, store).select("folder").distinct().collect()}
    new = [f for f in folders if f not in known]
    if new:
        base = f"{root}/{version.base}"
        found = spark.read.schema(T.StructType.fromJson(json.loads(version.schema))).option("basePath", base).parquet(*[f"{base}/{f}" for f in new])
        # a file's folder, relative to the base: the part of its path from the attempt on
        folder = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "(attempt=.*)/[^/]+$", 1)
        tables.write_plain(profiled(found.withColumn("folder", folder), columns), f"{store}/run-{uuid.uuid4().hex}")
    return new


def stored(spark: SparkSession, store: str) -> DataFrame:
    """All profiles in a store; each run's are a folder of their own."""
    runs = [f"{store}/{n}" for n in storage.names(spark, store) if n.startswith("run-")]
    return spark.read.schema(PROFILE).parquet(*runs) if runs else spark.createDataFrame([], PROFILE)


def table_profile(spark: SparkSession, root: str, store: str) -> DataFrame:
    """``name, rows, nulls, null_rate, low, high, distinct_values`` of the current version, from stored
    profiles alone; numbers are compared as numbers, and ``distinct_values`` is an estimate."""
    version = commits.latest(spark, root)
    folders = spark.createDataFrame([(f,) for f in (version.folders if version else ())], "folder string")
    own = stored(spark, store).dropDuplicates(["folder", "name"]).join(folders, "folder", "left_semi")
    edge = lambda number, text: F.coalesce(number.cast("string"), text)
    return own.groupBy("name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        (F.sum("nulls") / F.nullif(F.sum("rows"), F.lit(0))).alias("null_rate"),
        edge(F.min("low_number"), F.min("low")).alias("low"),
        edge(F.max("high_number"), F.max("high")).alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )
