"""Parquet folders, versioned tables, current views, exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def partition_last(df: DataFrame, partition: str = "year") -> DataFrame:
    return df.select(*[c for c in df.columns if c != partition], partition)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition value together, in tasks of even size.

    The rebalance hint lets the adaptive planner split a value that holds much of the
    data and merge small ones, so a skewed year is neither one task nor many tiny files.
    """
    return df.hint("rebalance", *columns)


def in_place(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition value together within each task, without a shuffle.

    For rows that a shuffle by a unique key has dealt evenly: a value that holds much of the data is spread over
    all tasks. Each task writes one file per value it holds.
    """
    return df.sortWithinPartitions(*columns)


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("year",),
    incremental: bool = False,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    deal: Callable[..., DataFrame] = balanced,
) -> None:
    """Overwrite a folder partitioned by columns.

    ``incremental`` replaces only the partitions the frame has rows for. ``finish`` is applied to the
    rows where they are written, compiled apart; it keeps the partition columns. ``deal`` is
    :func:`balanced`, or :func:`in_place` for rows that lie in even tasks already.
    """
    mode = "dynamic" if incremental else "static"
    dealt = deal(df, *partitions)
    (
        (finish(dealt) if finish else dealt)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_plain(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def version_name(mart: str, run_dt: str, attempt: str | None = None) -> str:
    return f"{mart}__{run_dt.replace('-', '')}" + (f"_{attempt}" if attempt else "")


def write_version(
    df: DataFrame,
    mart: str,
    run_dt: str,
    path: str,
    database: str = "default",
    partition: str | None = "year",
    attempt: str | None = None,
) -> str:
    """Build ``<mart>__YYYYMMDD`` at its own folder; a second run replaces the first.

    With an ``attempt`` the table and folder carry it in their names and no earlier one is
    touched. The table is external, so dropping it leaves the folder and the overwrite below
    clears exactly that folder. Rows lie in the order of their key, so that a look-up of one
    key reads few row groups.
    """
    spark = df.sparkSession
    table = f"{database}.{version_name(mart, run_dt, attempt)}"
    path = f"{path}/attempt={attempt}" if attempt else path
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if partition is None:
        rows, writer_of = df, lambda d: d.write
    else:
        rows = balanced(partition_last(df, partition), partition)
        if "county_fips" in df.columns:
            rows = rows.sortWithinPartitions(partition, "county_fips")
        writer_of = lambda d: d.write.partitionBy(partition)
    (
        writer_of(rows)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("path", path)
        .option("compression", "snappy")
        .format("parquet")
        .saveAsTable(table)
    )
    return table


def current_name(mart: str, database: str = "default") -> str:
    return f"{database}.{mart}_current"


def promote(spark: SparkSession, mart: str, table: str, database: str = "default") -> str:
    """Point the ``_current`` view at a version; an older version is a rollback."""
    view = current_name(mart, database)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return view


def pass_through_view(spark: SparkSession, source: str, target: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {source}")


def folder_view(spark: SparkSession, name: str, path: str, database: str = "default") -> str:
    """A view over a Parquet folder, so that a cleaned table can be queried by name."""
    view = f"{database}.{name}"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return view


def drop_tables(spark: SparkSession, names: Sequence[str], database: str = "default") -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def create_empty_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, database: str = "default"
) -> str:
    table = f"{database}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.createDataFrame([], schema).write.mode("overwrite").option("path", path).format("parquet").saveAsTable(table)
    return table


def table_location(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").select("data_type").first()
    return rows[0] if rows else None


def check_tables(
    spark: SparkSession, expected: dict[str, str | None], hard_fail: bool = True
) -> DataFrame:
    """Existence and location prefix per table name; ``None`` skips the location."""
    rows = []
    for table, prefix in expected.items():
        exists = spark.catalog.tableExists(table)
        location = table_location(spark, table) if exists else None
        ok = exists and (prefix is None or _plain(location).startswith(_plain(prefix)))
        if hard_fail and not ok:
            raise RuntimeError(f"table {table}: exists={exists}, location={location}, expected {prefix}")
        rows.append((table, exists, location, ok))
    return spark.createDataFrame(rows, "table_name string, table_exists boolean, location string, ok boolean")


def _plain(location: str | None) -> str:
    text = location or ""
    return "/" + text[len("file:"):].lstrip("/") if text.startswith("file:") else text


def export_csv(ranked: DataFrame, path: str, order: Sequence | None = None, limit: int | None = None) -> None:
    """A ranked set as CSV with a header: one file if it has a ``limit``, which is one task's
    worth of rows, else as many as there are tasks."""
    rows = ranked.orderBy(*order) if order else ranked
    rows = rows if limit is None else rows.limit(limit).coalesce(1)
    rows.write.mode("overwrite").option("header", True).csv(path)
