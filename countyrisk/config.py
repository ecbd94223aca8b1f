"""Dataset locations and the year window."""

from __future__ import annotations

from dataclasses import dataclass

# First and last year kept in the Gold marts.
GOLD_FIRST_YEAR = 2010
GOLD_LAST_YEAR = 2023

# Keys known to be produced by adding codes as numbers.
KNOWN_BAD_FIPS = ("01340", "00390")


@dataclass(frozen=True)
class YearWindow:
    first: int = GOLD_FIRST_YEAR
    last: int = GOLD_LAST_YEAR


@dataclass(frozen=True)
class Paths:
    """Folders of one deployment: ``<root>/{bronze,silver,gold,ops}/...``."""

    root: str

    def bronze(self, dataset: str) -> str:
        return f"{self.root}/bronze/{dataset}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, mart: str, run_dt: str) -> str:
        return f"{self.versions(mart)}/run_dt={run_dt}"

    def versions(self, mart: str) -> str:
        """Folder of all versions of a mart and of its commit log."""
        return f"{self.root}/gold/{mart}"

    def ops(self, table: str) -> str:
        return f"{self.root}/ops/{table}"
