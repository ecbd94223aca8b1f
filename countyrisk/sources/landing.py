"""Listings of landed files: newest versions, manifests, coverage."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .listing import can_list, hashed, listed

# Form of a yearly storm-event file name, and the lowest row count of a county table.
EVENT_FILE = r"^(.*_(details|fatalities|locations)-ftp_v1\.0_d(\d{4}))(?:_c(\d{8}))?\.csv\.gz$"
MIN_COUNTY_ROWS = 3000
OK, SKIPPED, EMPTY = "OK", "SKIPPED_EXISTS", "EMPTY"


def year_scope(
    spark: SparkSession, mode: str, run_dt: str, first: int, last: int, offset: int = 0
) -> DataFrame:
    """Years a run covers: ``backfill`` is first..last, else the run year plus an offset."""
    if (mode or "monthly").strip().lower() == "backfill":
        if last < first:
            raise ValueError("backfill: the last year lies before the first")
        bounds = (first, last)
    else:
        bounds = (int(run_dt[:4]) + offset,) * 2
    return spark.range(1).select(F.explode(F.sequence(F.lit(bounds[0]), F.lit(bounds[1]))).alias("year"))


def parse_listing(listing: DataFrame, name: str = "name") -> DataFrame:
    """Prefix, type, year and creation stamp of each event file name."""
    part = lambda i: F.nullif(F.regexp_extract(F.col(name), EVENT_FILE, i), F.lit(""))
    return listing.withColumns(
        {"prefix": part(1), "filetype": part(2), "year": part(3).try_cast("int"), "stamp": part(4)}
    )


def latest_files(listing: DataFrame, name: str = "name") -> DataFrame:
    """Newest file per type and year, by the stamp in its name."""
    return (
        parse_listing(listing, name)
        .filter("prefix IS NOT NULL AND stamp IS NOT NULL")
        .groupBy("filetype", "year")
        .agg(F.max_by(F.col(name), F.struct("stamp", name)).alias(name), F.max("stamp").alias("stamp"))
    )


def _binary(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )


def plain_path(column: str | Column) -> Column:
    """Readers differ in how they write the scheme of a local path."""
    return F.regexp_replace(column, "^file:/+", "/")


def _matching(glob: str) -> str:
    """A file name pattern (``*``, ``?`` and one level of ``{a,b}``) as a regular expression."""
    signs = {"*": ".*", "?": ".", "{": "(?:", "}": ")", ",": "|"}
    return "^" + "".join(signs.get(c, re.escape(c)) for c in glob) + "$"


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, name, bytes`` of the files below a folder, empty ones too; names that begin with ``_`` or ``.``
    are left out. Tasks list the folders (:mod:`.listing`). On a file system that only Spark opens, its
    own scan takes their place, which has no empty files."""
    if not can_list(path):
        return file_stats(spark, path, glob).select("path", "name", "bytes")
    found = listed(spark, path).filter(F.col("name").rlike(_matching(glob)) & ~F.col("name").rlike("^[_.]"))
    return found.select(plain_path("path").alias("path"), "name", "bytes")


def file_stats(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, name, bytes, modified`` of the files with content below a folder; their bytes are not read."""
    found = _binary(spark, path, glob).select(plain_path("path").alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "modified")


def _content_hashes(files: DataFrame) -> DataFrame:
    return files.select(plain_path("path").alias("path"), F.sha2("content", 256).alias("sha256"))


def hashes_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, sha256`` of named files, hashed as :func:`file_hashes` does."""
    if all(can_list(p) for p in paths):
        return hashed(spark.createDataFrame([(p,) for p in paths], "path string"))
    return _content_hashes(spark.read.format("binaryFile").load(paths))


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SHA-256 of each landed file, read in chunks, so that a file may be larger than a task's memory. On a
    file system that only Spark opens, a file is one value of a row."""
    if can_list(path):
        return hashed(list_files(spark, path, glob).select("path"))
    return _content_hashes(_binary(spark, path, glob))


def file_rows(spark: SparkSession, path: str, glob: str = "{*.csv,*.csv.gz}") -> DataFrame:
    """Data rows per CSV file, the header not counted."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    return (
        lines.groupBy(plain_path("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("lines"))
        .select("path", F.greatest(F.col("lines") - 1, F.lit(0)).alias("row_count"))
    )


def landing_manifest(spark: SparkSession, path: str, run_dt: str, glob: str = "{*.csv,*.csv.gz}") -> DataFrame:
    """One row per landed file: path, bytes, hash, rows, run date, status."""
    return (
        list_files(spark, path, glob)
        .join(file_hashes(spark, path, glob), "path", "left")
        .join(file_rows(spark, path, glob), "path", "left")
        .withColumns(
            {
                "row_count": F.coalesce("row_count", F.lit(0)),
                "sha256": F.coalesce("sha256", F.sha2(F.lit(""), 256)),
                "run_dt": F.lit(run_dt).cast("date"),
                "status": F.when(F.col("bytes") == 0, EMPTY).otherwise(OK),
            }
        )
    )


def not_landed(listing: DataFrame, manifest: DataFrame, same: Sequence[str] = ("name", "bytes")) -> DataFrame:
    """Listed files that the manifest does not have with the same name and size."""
    return listing.join(manifest.select(*same).distinct(), list(same), "left_anti")


def with_landing_status(listing: DataFrame, manifest: DataFrame, same: Sequence[str] = ("name", "bytes")) -> DataFrame:
    known = manifest.select(*same).distinct().withColumn("__known", F.lit(1))
    status = F.when(F.col("__known") == 1, SKIPPED).otherwise("NEW")
    return listing.join(known, list(same), "left").withColumn("status", status).drop("__known")


def expected_pairs(years: DataFrame, filetypes: Sequence[str]) -> DataFrame:
    return years.select("year", F.explode(F.array(*[F.lit(t) for t in filetypes])).alias("filetype"))


def missing_pairs(found: DataFrame, years: DataFrame, filetypes: Sequence[str]) -> DataFrame:
    """(year, type) pairs that should be there and are not."""
    return expected_pairs(years, filetypes).join(found.select("year", "filetype").distinct(), ["year", "filetype"], "left_anti")


def presence_checks(manifest: DataFrame, expected: DataFrame, min_rows: int = MIN_COUNTY_ROWS) -> DataFrame:
    """Per expected file: is it there, is it empty, does it have enough rows."""
    known = manifest.select("name", "bytes", "row_count")
    return expected.join(known, "name", "left").select(
        "name",
        F.col("bytes").isNull().alias("missing"),
        F.coalesce(F.col("bytes") == 0, F.lit(False)).alias("zero_size"),
        F.coalesce(F.col("row_count") < min_rows, F.lit(False)).alias("too_few_rows"),
    )


def dataset_sizes(manifest: DataFrame, dataset: str = "dataset", sample: int = 10) -> DataFrame:
    """Files, bytes and the first names per data set.

    Names are ranked within their data set before they are gathered, and the ranking
    keeps ``sample`` rows per data set ahead of the shuffle.
    """
    first = Window.partitionBy(dataset).orderBy("name")
    names = (
        manifest.withColumn("__n", F.row_number().over(first))
        .filter(F.col("__n") <= sample)
        .groupBy(dataset)
        .agg(F.sort_array(F.collect_list("name")).alias("sample_files"))
    )
    return (
        manifest.groupBy(dataset)
        .agg(F.count("*").alias("file_count"), F.sum("bytes").alias("total_bytes"))
        .withColumn("total_mb", F.round(F.col("total_bytes") / 1_000_000, 2))
        .join(names, dataset)
    )


def is_ready(listing: DataFrame) -> DataFrame:
    """One row: does the listing hold at least one file."""
    return listing.limit(1).agg((F.count("*") > 0).alias("ready"))
