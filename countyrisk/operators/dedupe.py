"""One row per key, latest row per key, surrogate keys.

``row_number() = 1`` is planned with a group limit before the shuffle, so each map
task sends one row per key. A key that holds a large share of the rows therefore
costs one small group in the reducer, not one huge one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"
# Keys that share a row of a filter, and the most that a filter is made of (some 200 MB in each executor).
KEYS_PER_ROW, MOST_KEYS = 128, 1 << 26


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe(
    df: DataFrame, keys: Iterable[str], latest: Sequence[str] = ("run_dt",)
) -> DataFrame:
    """One row per key, the same row on every run.

    Keys that do not exist are left out; without any key the frame is unchanged.
    The row with the greatest ``latest`` column wins, ties go to the smallest row
    by the other columns in order.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    newest = [F.col(c).desc_nulls_last() for c in latest if c in df.columns]
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys and c not in latest]
    if not newest and not rest:
        return df.distinct()
    return first_per_key(df, keys, newest + rest)


def dedupe_with_fallback(
    df: DataFrame, keys: Iterable[str], fallback: Iterable[str], latest: Sequence[str] = ("run_dt",)
) -> DataFrame:
    """By ``keys`` if all of them exist, else by ``fallback``."""
    keys = list(keys)
    chosen = keys if all(k in df.columns for k in keys) else list(fallback)
    return dedupe(df, chosen, latest)


def latest_per_key(
    df: DataFrame, key: str, version: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Row with the greatest ``version`` per key; ties go to the smallest tie-break."""
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in (key, version)]
    order = [F.col(version).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tie_break]
    return first_per_key(df, [key], order)


def surrogate_key(
    df: DataFrame, columns: Iterable[str], out: str, null_token: str | None = None
) -> DataFrame:
    """SHA-256 of the columns joined by two pipes.

    NULLs are skipped, so ``(a, NULL, b)`` and ``(a, b)`` share a key; give
    ``null_token`` to keep them apart.
    """
    parts: list[Column] = [F.col(c).cast("string") for c in columns if c in df.columns]
    if not parts:
        return df
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return df.withColumn(out, F.sha2(F.concat_ws("||", *parts), 256))


def split_by_keys(df: DataFrame, found: DataFrame, keys: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not among those in ``found`` (about ``n``), and the rows whose key may be.

    A key is kept as a mark of two bytes, in a row with some others, and these rows are sent to all tasks, so ``df``
    is not shuffled. A mark may stand for another key by chance: such a row is in the second part, never in the first."""
    digest = F.xxhash64(*keys)
    place = F.pmod(digest, F.lit(max(1, n // KEYS_PER_ROW)).cast("long"))
    mark = F.shiftright(digest, 48).cast("short")
    marks = found.groupBy(place.alias("__place")).agg(F.collect_set(mark).alias("__marks"))
    joined = df.join(F.broadcast(marks), place == F.col("__place"), "left")
    here = F.coalesce(F.array_contains("__marks", mark), F.lit(False))
    return tuple(joined.filter(part).select(*df.columns) for part in (~here, here))
