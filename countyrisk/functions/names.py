"""Column names: snake case, duplicates, repeated header names, union-safe lists."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snake_case(name: str) -> str:
    """Words of the name in lower case, joined by single underscores."""
    words = re.split(r"[\W_]+", name.lower())
    return "_".join(w for w in words if w)


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def unique_names(names: Iterable[str]) -> list[str]:
    """Second and later uses of a name get ``__dup1``, ``__dup2`` and so on."""
    counts: dict[str, int] = {}
    out = []
    for name in names:
        n = counts.get(name, 0)
        out.append(f"{name}__dup{n}" if n else name)
        counts[name] = n + 1
    return out


def make_unique_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(df.columns))


def restore_repeated_headers(names: list[str], repeated: Iterable[str]) -> list[str]:
    """Undo the position suffix the CSV reader adds to repeated header names.

    The reader turns ``YEAR,Year`` into ``YEAR0,Year1``. Only the names the caller
    lists are looked at, so a real column such as ``b0`` is never touched.
    """
    wanted = {r.lower() for r in repeated}
    out = []
    for position, name in enumerate(names):
        suffix = str(position)
        base = name[: -len(suffix)] if name.endswith(suffix) else name
        out.append(base if base.lower() in wanted else name)
    return out


def normalize_header(df: DataFrame, repeated: Iterable[str] = ()) -> DataFrame:
    """Header clean-up in one projection: repeated names, snake case, uniqueness."""
    names = restore_repeated_headers(df.columns, repeated)
    return df.toDF(*unique_names(snake_case(n) for n in names))


def coalesce_columns(df: DataFrame, candidates: Iterable[str], out: str) -> DataFrame:
    """First non-null of the candidate columns that exist; unchanged if none does."""
    present = [F.col(c) for c in candidates if c in df.columns]
    return df.withColumn(out, F.coalesce(*present)) if present else df


def canonical_name_column(df: DataFrame, out: str = "name") -> DataFrame:
    """Fold ``name``, ``name0``, ``name__dup1`` … into one column ``out``."""
    pattern = re.compile(rf"^{re.escape(out)}(\d*|__dup\d+)$")
    found = [c for c in df.columns if pattern.match(c)]
    if not found:
        return df
    found.sort(key=lambda c: c != out)
    folded = F.coalesce(*[F.col(c) for c in found]).alias(out)
    return df.select(folded, *[F.col(c) for c in df.columns if c not in found])


def project_to(df: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    """Exactly these columns in this order; a missing one becomes a typed NULL."""
    return df.select(
        *[
            F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c)
            for c, t in columns.items()
        ]
    )
