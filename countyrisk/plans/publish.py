"""Build, check and promote a mart version; the run log."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks
from ..sinks import commits, tables

# How many blocking reports an error message names; all of them block.
NAMED_REPORTS = 20
MARTS = ("hazard_event_summary", "risk_feature_mart", "risk_feature_mart_scaffold")
LOG_SCHEMA = (
    "logged_at timestamp, run_id string, layer string, kind string, name string, "
    "status string, block_downstream boolean, payload string, run_dt date"
)


@dataclass(frozen=True)
class Published:
    mart: str
    table: str
    status: str
    blocked: bool
    promoted: bool
    results: DataFrame


class BlockedError(RuntimeError):
    """A blocking check failed or an upstream report blocks."""


def publish_version(
    df: DataFrame,
    mart: str,
    run_dt: str,
    path: str,
    suite_of: Callable[[DataFrame], checks.Suite] | None = None,
    database: str = "default",
    raise_on_block: bool = False,
    versions: str | None = None,
) -> Published:
    """Write a version, check what was written, promote it unless a check blocks.

    Each call writes a table of its own, so the version that ``_current`` shows stays whole
    until the new one has passed, also when one ``run_dt`` is run again; it stays after that
    too, for a rollback. With ``versions``, a folder above ``path``, promotion is first of all a commit
    in the log there, which any later session finds (:mod:`countyrisk.sinks.commits`)."""
    if mart not in MARTS:
        raise ValueError(f"unknown mart {mart!r}")
    spark = df.sparkSession
    attempt = uuid.uuid4().hex[:12]
    table = tables.write_version(df, mart, run_dt, path, database, attempt=attempt)
    written = spark.table(table)
    suite = suite_of(written) if suite_of else checks.Suite(mart, written)
    results = checks.run_checks(spark, suite)
    status, blocked = suite_verdict(results)
    if blocked and raise_on_block:
        raise BlockedError(f"blocking checks failed for {table}")
    if not blocked:
        if versions:
            note = {"run_dt": run_dt, "table": table, "status": status}
            commits.promote(spark, versions, f"{path}/attempt={attempt}", written.schema, note)
        tables.promote(spark, mart, table, database)
    return Published(mart, table, status, blocked, not blocked, results)


def suite_verdict(results: DataFrame) -> tuple[str, bool]:
    """Status of one suite; a suite without checks passes."""
    row = checks.overall_status(checks.suite_status(results)).first()
    return row["status"], row["block_downstream"]


def log_entry(
    spark: SparkSession,
    run_id: str,
    run_dt: str,
    layer: str,
    kind: str,
    name: str,
    payload: Mapping,
    status: str | None = None,
    block_downstream: bool = False,
) -> DataFrame:
    """One run-log row: a plan, a quality report, metadata, health or a summary."""
    row = (
        datetime.now(timezone.utc).replace(tzinfo=None),
        run_id,
        layer,
        kind,
        name,
        status,
        block_downstream,
        json.dumps(payload, sort_keys=True, default=str),
        datetime.strptime(run_dt, "%Y-%m-%d").date(),
    )
    return spark.createDataFrame([row], LOG_SCHEMA)


def append_log(entry: DataFrame, path: str) -> None:
    entry.write.mode("append").partitionBy("run_dt").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def blocking_reports(log: DataFrame, layer: str, run_dt: str | None = None) -> DataFrame:
    """Latest quality report per name of a layer, where that report blocks."""
    reports = log.filter((F.col("layer") == layer) & (F.col("kind") == "quality"))
    if run_dt is not None:
        reports = reports.filter(F.col("run_dt") == F.lit(run_dt).cast("date"))
    latest = reports.groupBy("name").agg(
        F.max_by(F.struct("block_downstream", "status", "run_id"), "logged_at").alias("r")
    )
    return latest.select("name", "r.*").filter("block_downstream")


def require_unblocked(log: DataFrame, layer: str, run_dt: str | None = None) -> None:
    """Stop the next layer when an upstream report blocks."""
    reports = blocking_reports(log, layer, run_dt)
    names = [r["name"] for r in reports.orderBy("name").limit(NAMED_REPORTS).collect()]
    if names:
        raise BlockedError(f"{layer} blocks downstream work: {reports.count()} reports, first {names}")
