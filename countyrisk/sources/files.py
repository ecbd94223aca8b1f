"""Readers for raw and cleaned data."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.names import normalize_columns, normalize_header, snake_case
from .landing import file_stats
from .listing import can_list
from .pages import page_elements

# Data files only: metadata files beside them end in .json.
CSV_FILES = "{*.csv,*.csv.gz}"
CORRUPT = "_corrupt_record"


def read_csv_text(spark: SparkSession, path: str | list[str], repeated: Iterable[str] = ()) -> DataFrame:
    """CSV with a header, every column a string, names in snake case.

    ``repeated`` lists header names that may occur twice (the reader numbers those).
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("pathGlobFilter", CSV_FILES)
        .csv(path)
    )
    return normalize_header(raw, repeated)


# Bytes by the unit that a setting may end in.
UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def in_bytes(size: str) -> int:
    """A size as in ``128MB`` or ``134217728b``."""
    text = size.strip().lower()
    number = text.rstrip("kmgb")
    return int(number) * UNITS[(text.removeprefix(number) or "b")[0]]


def setting_bytes(spark: SparkSession, name: str) -> int:
    """A size setting of the session."""
    return in_bytes(spark.conf.get(name))


def task_count(spark: SparkSession, total: int) -> int:
    """Tasks that Spark's own reader would deal a splittable input of ``total`` bytes to."""
    most, least = setting_bytes(spark, "spark.sql.files.maxPartitionBytes"), setting_bytes(spark, "spark.sql.files.openCostInBytes")
    each = min(most, max(least, total // spark.sparkContext.defaultParallelism))
    return max(1, -(-total // each))


@contextmanager
def split_size(spark: SparkSession, size: str) -> Iterator[None]:
    """Files are read in splits of at most ``size`` by the jobs that run inside.

    For rows that are much wider once read than they are in the file, so that a read task sorts them in memory."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, min(before, size, key=in_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame, path: str, glob: str = "*") -> DataFrame:
    """Rows of files that can't be split, in as many even tasks as a splittable input of their size.

    The files' sizes are measured. The reader packs whole files into tasks, largest first; only if one
    file is as large as two even shares, the rows are dealt anew after the read."""
    spark = df.sparkSession
    sizes = file_stats(spark, path, glob).agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0)))
    total, largest = sizes.first()
    tasks = task_count(spark, total)
    return df.repartition(tasks) if tasks > 1 and largest * tasks >= 2 * total else df


def spread_parquet(df: DataFrame, path: str) -> DataFrame:
    """Rows of Parquet files in even tasks.

    A file is split between its row groups only. The rows of each read task are counted, from the footers,
    and the rows are dealt anew only if one task reads as many as two even shares."""
    tasks = task_count(df.sparkSession, file_stats(df.sparkSession, path).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0])
    read = df.groupBy(F.spark_partition_id()).count()
    total, largest = read.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    return df.repartition(tasks) if tasks > 1 and largest * tasks >= 2 * total else df


def read_csv_gz(spark: SparkSession, path: str, repeated: Iterable[str] = ()) -> DataFrame:
    """Compressed CSV. A gzip file is one task while it is read; after that rows are spread by measured size."""
    return spread(read_csv_text(spark, path, repeated), path, CSV_FILES)


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keep_corrupt: bool = False,
    required: Iterable[str] | None = None,
) -> DataFrame:
    """Quoted CSV, its columns found by header name and cast to the declared types.

    Header names are matched in snake case, in any order; columns that aren't declared are
    not read. A missing column is an error if it is ``required`` (by default all are), else
    NULL. Unreadable values become NULL. With ``keep_corrupt`` the values of a row that has
    one are kept as JSON text in one more column.
    """
    raw = normalize_header(
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", "\\")
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", CSV_FILES)
        .csv(path)
    )
    wanted = {f.name: snake_case(f.name) for f in schema}
    needed = wanted if required is None else list(required)
    missing = sorted(c for c in needed if wanted.get(c, c) not in raw.columns)
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    typed = {
        f.name: F.col(wanted[f.name]).try_cast(f.dataType) if wanted[f.name] in raw.columns else F.lit(None).cast(f.dataType)
        for f in schema
    }
    columns = [column.alias(name) for name, column in typed.items()]
    if keep_corrupt:
        read = [name for name in typed if wanted[name] in raw.columns]
        lost = [F.col(wanted[name]).isNotNull() & typed[name].isNull() for name in read]
        row = F.to_json(F.struct(*[F.col(wanted[name]).alias(name) for name in read]))
        columns.append(F.when(reduce(or_, lost, F.lit(False)), row).alias(CORRUPT))
    return raw.select(*columns)


def read_bronze(spark: SparkSession, path: str, dataset: str, keep_corrupt: bool = False) -> DataFrame:
    """Typed reader of one of the raw data sets; its declared columns are found by name."""
    if dataset not in schemas.BRONZE:
        raise ValueError(f"unknown raw data set {dataset!r}")
    return read_csv_typed(spark, path, schemas.BRONZE[dataset], keep_corrupt, schemas.BRONZE_REQUIRED.get(dataset))


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """ZIP crosswalk with a fixed schema: Parquet if the path says so, else CSV by header name."""
    if path.rstrip("/").endswith(".parquet"):
        return normalize_columns(spark.read.parquet(path))
    return read_csv_typed(spark, path, schemas.CROSSWALK)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with partition folders as columns."""
    return spark.read.parquet(path)


def with_file_path(df: DataFrame, out: str = "source_path") -> DataFrame:
    return df.withColumn(out, F.col("_metadata.file_path"))


def decode_feature_pages(pages: DataFrame, attributes: str, value: str = "value") -> DataFrame:
    """Pages ``{"features": [{"attributes": {…}}, …]}`` as one row per feature.

    Each page is decoded within its row. ``attributes`` is the DDL of the wanted
    columns; other attributes are skipped by the parser.
    """
    document = F.from_json(F.col(value), f"features array<struct<attributes: struct<{_fields(attributes)}>>>")
    features = pages.select(F.explode(document["features"]).alias("f"))
    return normalize_columns(features.select("f.attributes.*"))


def _fields(ddl: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (c.split() for c in ddl.split(",")))


def read_feature_pages(spark: SparkSession, path: str, attributes: str) -> DataFrame:
    """Landed feature pages, one document per file, read piecewise (:mod:`.pages`): a page may be larger than
    a task's memory. On a file system that only Spark opens, a page is one value of a row."""
    if not can_list(path):
        return decode_feature_pages(spark.read.text(path, wholetext=True), attributes)
    features = page_elements(spark, path, "features")
    one = F.from_json("value", f"struct<attributes: struct<{_fields(attributes)}>>")
    return normalize_columns(features.select(one.alias("f")).select("f.attributes.*"))


def decode_header_arrays(documents: DataFrame, columns: Iterable[str], value: str = "value") -> DataFrame:
    """Documents ``[[header…], [row…], …]`` as rows with the wanted columns.

    Each document is decoded within its row; a document with fewer than two entries
    gives nothing. ``columns`` are matched to the header without regard to case.
    """
    table = F.from_json(F.col(value), "array<array<string>>")
    rows = (
        documents.select(table.alias("__table"))
        .filter(F.size("__table") >= 2)
        .select(
            F.transform(F.element_at("__table", 1), F.lower).alias("__header"),
            F.explode(F.slice("__table", F.lit(2), F.size("__table") - 1)).alias("__row"),
        )
    )
    record = F.map_from_arrays("__header", "__row")
    return rows.select(record.alias("__record")).select(
        *[F.try_element_at("__record", F.lit(c.lower())).alias(c.lower()) for c in columns]
    )


def read_header_arrays(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """Files that each hold one array-of-arrays document, read like :func:`read_feature_pages`."""
    if not can_list(path):
        return decode_header_arrays(spark.read.text(path, wholetext=True), columns)
    rows = page_elements(spark, path).filter("place > 0")
    texts = lambda c: F.from_json(c, "array<string>")
    record = F.map_from_arrays(F.transform(texts("head"), F.lower), texts("value"))
    return rows.select(record.alias("__record")).select(
        *[F.try_element_at("__record", F.lit(c.lower())).alias(c.lower()) for c in columns]
    )
