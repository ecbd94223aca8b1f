"""Cleaned tables and marts of one data folder, written once per session.

Queries over marts read written Parquet, as they do in production, so they do not
repeat the cleaning. The tables go to the cluster's shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import YearWindow
from ..functions import fips, names
from ..operators import rollups
from ..plans import gold, pipeline, silver
from ..session import scratch_dir
from ..sinks import tables
from ..sources import files
from . import adapters

WINDOW = YearWindow(adapters.FIRST_YEAR, adapters.LAST_YEAR)
# Raw rows hold each number as text: about 25 times the bytes that they have in their Parquet file.
RAW_SPLIT = "16MB"
_OPEN: dict[tuple[str, str], Workspace] = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._written: dict[str, str] = {}
        self._frames: dict[str, DataFrame] = {}

    @cached_property
    def root(self) -> str:
        return scratch_dir(self.spark, "workspace")

    def _frame(self, path: str) -> DataFrame:
        """Frame over a folder, listed and its schema read once per session."""
        if path not in self._frames:
            self._frames[path] = self.spark.read.parquet(path)
        return self._frames[path]

    def table(self, name: str) -> DataFrame:
        return self._frame(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table in even tasks: one whose file has one row group would be read by one task."""
        key = f"spread {name}"
        if key not in self._frames:
            self._frames[key] = files.spread_parquet(self.table(name), f"{self.sf_dir}/{name}.parquet")
        return self._frames[key]

    def raw(self, name: str) -> DataFrame:
        return adapters.raw_frame(self.spread(adapters.RAW[name][0]), name)

    def acs(self) -> dict[str, DataFrame]:
        return {t: self.raw(t) for t in silver.CENSUS_CELLS}

    def _read(self, name: str, build: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        def write(path: str) -> None:
            if partition:
                tables.write_partitioned(build(), path, (partition,))
            else:
                tables.write_plain(build(), path)

        return self._frame(self.written(name, write))

    def _clean(self, name: str, build: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        """A table made of raw rows, which are read in small splits."""
        with files.split_size(self.spark, RAW_SPLIT):
            return self._read(name, build, partition)

    def written(self, name: str, build: Callable[[str], None]) -> str:
        """Folder that ``build`` fills once."""
        if name not in self._written:
            path = f"{self.root}/{name}"
            build(path)
            self._written[name] = path
        return self._written[name]

    def events(self, outcome: str = "valid") -> DataFrame:
        with files.split_size(self.spark, RAW_SPLIT):
            path = self.written(
                "events",
                lambda p: pipeline.write_events(silver.matched_events(silver.keyed_events(self.raw("events")), self.counties()), p),
            )
        return self._frame(pipeline.events_path(path, outcome))

    def counties(self) -> DataFrame:
        return self._clean("counties", lambda: silver.county_reference(self.raw("nri")))

    def declarations(self) -> DataFrame:
        return self._clean("declarations", lambda: silver.clean_declarations(self.raw("declarations")))

    def claims(self) -> DataFrame:
        return self._clean("claims", lambda: silver.clean_claims(self.raw("owners"), self.raw("renters")))

    def scores(self) -> DataFrame:
        return self._clean("scores", lambda: silver.clean_scores(self.raw("nri"))[0])

    def scores_unresolved(self) -> DataFrame:
        return self._clean("scores_unresolved", lambda: silver.clean_scores(self.raw("nri"))[1])

    def census(self) -> DataFrame:
        return self._clean("census", lambda: silver.clean_census(self.acs()))

    def census_years(self) -> DataFrame:
        """Population rows of several census years per county."""
        return self._clean("census_years", lambda: census_by_year(self.raw("b01001")))

    def crosswalk(self) -> DataFrame:
        return self._clean("crosswalk", lambda: silver.clean_crosswalk(self.raw("crosswalk")), "year")

    def type_map(self) -> DataFrame:
        return self._read("type_map", lambda: self.raw("type_map"))

    def centroids(self) -> DataFrame:
        return self._read("centroids", lambda: gold.county_centroids(self.raw("centroids")))

    def summary(self) -> DataFrame:
        return self._read("summary", lambda: gold.hazard_event_summary(self.events(), WINDOW), "year")

    def summary_lenient(self) -> DataFrame:
        return self._read("summary_lenient", lambda: gold.hazard_event_summary_lenient(self.events()), "year")

    def mart(self) -> DataFrame:
        return self._read("mart", lambda: self.build_mart(), "year")

    def build_mart(self) -> DataFrame:
        return gold.feature_mart(
            self.events(), self.claims(), self.declarations(), self.crosswalk(), self.census(), self.scores(), WINDOW
        )

    def dim(self) -> DataFrame:
        return self._read("dim", lambda: gold.county_dim(self.scores(), self.census()))

    def years(self) -> DataFrame:
        return rollups.years_in_scope(self.events(), self.declarations())

    def universe(self) -> DataFrame:
        return self._read("universe", lambda: gold.county_year_universe(self.dim(), self.years()), "year")

    def scaffold(self) -> DataFrame:
        return self._read("scaffold", lambda: self.build_scaffold(), "year")

    def build_scaffold(self) -> DataFrame:
        return gold.feature_mart_scaffold(
            self.universe(), self.summary_lenient(), self.claims(), self.declarations(), self.census(), self.scores()
        )


def census_by_year(raw: DataFrame) -> DataFrame:
    rows = names.normalize_columns(raw)
    return rows.select(
        fips.standard_fips(fips.fips_from_codes("state", "county")).alias("county_fips"),
        F.col("name").alias("county_name"),
        F.col("acs_year").try_cast("int").alias("acs_year"),
        F.col("b01001_001e").try_cast("bigint").alias("population_total"),
    )


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, sf_dir)
    return _OPEN[key]
