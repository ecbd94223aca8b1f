"""Named queries and the SQL each is checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .oracle import with_ctes
from .workspace import Workspace

Query = Callable[[Workspace], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` may use any common table of :mod:`.oracle`."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_ctes(oracle)
        return fn

    return register
