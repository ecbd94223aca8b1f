"""Damage text such as ``10K`` or ``2.5M`` to US dollars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scale(suffix: Column) -> Column:
    # Multiplier of each suffix.
    return (
        F.when(suffix == "K", F.lit(1e3)).when(suffix == "M", F.lit(1e6)).when(suffix == "B", F.lit(1e9))
    )


def damage_usd_strict(c: Column | str) -> Column:
    """Number with an optional K/M/B; NULL, blank and anything else count as 0."""
    text = F.upper(F.trim(F.col(c) if isinstance(c, str) else c))
    pattern = r"^([0-9]+(?:\.[0-9]+)?)([KMB]?)$"
    number = F.regexp_extract(text, pattern, 1).try_cast("double")
    scale = F.coalesce(_scale(F.regexp_extract(text, pattern, 2)), F.lit(1.0))
    return F.coalesce(number * scale, F.lit(0.0))


def damage_usd_lenient(c: Column | str) -> Column:
    """``$`` and ``,`` are dropped first; NULL, blank and unreadable text stay NULL."""
    text = F.trim(F.regexp_replace(F.col(c) if isinstance(c, str) else c, "[$,]", ""))
    scale = _scale(F.upper(F.right(text, F.lit(1))))
    body = F.when(scale.isNotNull(), F.left(text, F.length(text) - 1)).otherwise(text)
    return body.try_cast("double") * F.coalesce(scale, F.lit(1.0))


def damage_usd(c: Column | str, parser: str = "strict") -> Column:
    parsers = {"strict": damage_usd_strict, "lenient": damage_usd_lenient}
    if parser not in parsers:
        raise ValueError(f"unknown damage parser {parser!r}")
    return parsers[parser](c)
