"""A byte n-gram model with modified Kneser-Ney smoothing, counted by Spark.

The n-grams of every byte of every text are counted (order 4, each text led by three line
feeds); lower orders, discounts, context weights and interpolated probabilities are grouped
and joined from these counts as DataFrames. Nothing is left out: the n-grams and context
weights are dealt by a one-to-one hash of their 32-bit code into parts of about
``PART_ENTRIES`` entries, sorted by code, and each part is a broadcast of its own. So the
model grows with the input, but the driver and each worker hold one part at a time: a
worker looks up the distinct n-grams of a batch of texts part by part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .lengths import written
from .text import byte_blocks, row_sums

PART_ENTRIES = 1 << 21
MULTIPLIER = 2654435761
LEAD = 0x0A
MERGE_AT = 1 << 22


class Table(NamedTuple):
    """Sorted codes and the base-2 logarithm of each."""

    codes: np.ndarray
    values: np.ndarray


class Model(NamedTuple):
    """Broadcasts of the parts (each a :class:`Table`), and the orders that have a fixed size."""

    fours: list[Broadcast]
    threes: list[Broadcast]
    weights: list[Broadcast]
    twos: np.ndarray
    pair_weights: np.ndarray
    ones: np.ndarray


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The four bytes that end at each byte, as one number; texts are led by line feeds."""
    rows = len(offsets) - 1
    padded = np.full(len(data) + 3 * rows, LEAD, np.uint32)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    at = np.arange(len(data)) + 3 * (owner + 1)
    padded[at] = data
    codes = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    return codes[at - 3]


def count_grams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``code, n``: all n-grams of all texts; tasks add up their own before the shuffle."""

    def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate(codes), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate(counts).astype(np.float64)).astype(np.int64)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, held = [], [], 0
        for batch in batches:
            for _, offsets, data in byte_blocks(batch.column(0)):
                keys, n = np.unique(gram_codes(data, offsets), return_counts=True)
                codes.append(keys)
                counts.append(n)
                held += len(keys)
                if held > MERGE_AT:
                    keys, n = merged(codes, counts)
                    codes, counts, held = [keys], [n], 0
                    if len(keys) > MERGE_AT // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["code", "n"])
                        codes, counts = [], []
        if codes:
            keys, n = merged(codes, counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["code", "n"])

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(counted, "code long, n long")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def discounts(grams: DataFrame) -> list[float]:
    """The three modified Kneser-Ney discounts of one order."""
    rows = grams.where("n <= 4").groupBy("n").count().collect()
    of = {r["n"]: r["count"] for r in rows}
    n = [of.get(k, 0) for k in range(5)]
    if not all(n[1:4]):
        return [0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), float(k)) for k in (1, 2, 3)]


def smoothed(grams: DataFrame, lower: DataFrame | None, mask: int) -> tuple[DataFrame, DataFrame]:
    """(``code, n, p`` of one order, ``context, weight``); ``lower`` is the order below."""
    d = discounts(grams)
    cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    split = grams.withColumn("context", F.shiftright("code", 8))
    contexts = split.groupBy("context").agg(F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("weight"))
    rest = split.join(contexts, "context").withColumn("suffix", F.col("code").bitwiseAND(F.lit(mask)))
    own = F.greatest(F.col("n") - cut, F.lit(0.0)) / F.col("total")
    if lower is None:
        below = F.lit(1 / 256)
    else:
        rest = rest.join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix")
        below = F.col("below")
    return rest.select("code", "n", (own + F.col("weight") * below).alias("p")), contexts.select("context", "weight", "total")


def part_of(codes: np.ndarray, parts: int) -> np.ndarray:
    """The part that each code is dealt to."""
    return ((codes * np.uint32(MULTIPLIER)).astype(np.uint64) * np.uint64(parts)) >> np.uint64(32)


def dealt(frame: DataFrame, code: str, value: str) -> list[Broadcast]:
    """All rows of a frame as broadcast parts; the driver holds one of them at a time."""
    spark = frame.sparkSession
    rows = written(frame.select(F.col(code).alias("code"), F.log2(value).cast("float").alias("value")), "model")
    parts = max(1, -(-rows.count() // PART_ENTRIES))
    if parts > 1:
        # code * MULTIPLIER modulo 2^32, in halves that stay below 2^63
        low, high = F.col("code").bitwiseAND(F.lit(0xFFFF)) * F.lit(MULTIPLIER), F.shiftright("code", 16) * F.lit(MULTIPLIER)
        hashed = (low + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(0xFFFFFFFF))
        path = scratch_dir(spark, "model-parts")
        placed = rows.withColumn("part", F.shiftright(hashed * F.lit(parts), 32).cast("int"))
        placed.repartition(parts, "part").write.mode("overwrite").partitionBy("part").parquet(path)
        rows = spark.read.schema(placed.schema).parquet(path)
    out = []
    for k in range(parts):
        own = (rows.where(F.col("part") == k) if parts > 1 else rows).select("code", "value").toArrow()
        codes = own.column("code").to_numpy().astype(np.uint32)
        order = np.argsort(codes)
        out.append(spark.sparkContext.broadcast(Table(codes[order], own.column("value").to_numpy()[order])))
    return out


def fit_model(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts of ``docs``; with no text every byte has probability 1/256."""
    fours = written(count_grams(docs, text_col), "grams-4")
    fewer = lambda grams, mask: grams.groupBy(F.col("code").bitwiseAND(F.lit(mask)).alias("code")).agg(F.count("*").alias("n"))
    threes = written(fewer(fours, 0xFFFFFF), "grams-3")
    twos = written(fewer(threes, 0xFFFF), "grams-2")
    ones = fewer(twos, 0xFF)
    p1, context1 = smoothed(ones, None, 0)
    p1 = written(p1, "smooth-1")
    p2, context2 = smoothed(twos, p1, 0xFF)
    p2 = written(p2, "smooth-2")
    p3, context3 = smoothed(threes, p2, 0xFFFF)
    p3 = written(p3, "smooth-3")
    p4, context4 = smoothed(fours, p3, 0xFFFFFF)

    def dense(frame: DataFrame, key: str, value: str, size: int) -> np.ndarray:
        out = np.full(size, np.nan, np.float32)
        rows = frame.select(key, F.log2(value).alias("v")).toArrow()
        out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
        return out

    def weights(frame: DataFrame, size: int) -> np.ndarray:
        return np.nan_to_num(dense(frame, "context", "weight", size), nan=0.0)

    floor = weights(context1, 1)[0] - 8
    first = np.where(np.isnan(one := dense(p1, "code", "p", 256)), floor, one)
    # two bytes: 65,536 of them at most, so the unseen ones are filled in
    pair = dense(p2, "code", "p", 1 << 16)
    unseen = (weights(context2, 256)[:, None] + first[None, :]).ravel()
    return Model(
        dealt(p4, "code", "p"),
        dealt(p3, "code", "p"),
        dealt(context4, "context", "weight"),
        np.where(np.isnan(pair), unseen, pair).astype(np.float32),
        weights(context3, 1 << 16),
        first.astype(np.float32),
    )


class Known(NamedTuple):
    """Sorted codes, the base-2 logarithm of each, and a direct index that most of them are found by."""

    codes: np.ndarray
    logs: np.ndarray
    index: np.ndarray
    shift: np.uint32

    def of(self, codes: np.ndarray) -> np.ndarray:
        at = self.index[(codes * np.uint32(MULTIPLIER)) >> self.shift]
        others = np.flatnonzero(self.codes[at] != codes)
        at[others] = np.searchsorted(self.codes, codes[others])
        return self.logs[at]


class Scorer:
    """Looks up the distinct n-grams of some texts, then scores the texts."""

    def __init__(self, model: Model):
        self.model = model

    @staticmethod
    def _look_up(parts: list[Broadcast], codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), np.nan, np.float32)
        owner = part_of(codes, len(parts))
        for k, part in enumerate(parts):
            mine = np.flatnonzero(owner == k)
            table = part.value
            if len(parts) > 1:
                part.__dict__.pop("_value", None)  # else every part stays in the worker's memory
            if len(mine) and len(table.codes):
                at = np.minimum(np.searchsorted(table.codes, codes[mine]), len(table.codes) - 1)
                hit = table.codes[at] == codes[mine]
                out[mine[hit]] = table.values[at[hit]]
        return out

    def known(self, blocks: list[tuple[int, np.ndarray, np.ndarray]]) -> Known:
        """The n-grams of all texts of some blocks."""
        found, held = [np.zeros(0, np.uint32)], 0
        for _, offsets, data in blocks:
            found.append(np.unique(gram_codes(data, offsets)))
            held += len(found[-1])
            if held > MERGE_AT:
                found, held = [np.unique(np.concatenate(found))], 0
        codes = np.unique(np.concatenate(found))
        logs = self._look_up(self.model.fours, codes)
        unseen = np.flatnonzero(np.isnan(logs))
        if len(unseen):
            short = codes[unseen]
            weight = np.nan_to_num(self._look_up(self.model.weights, short >> np.uint32(8)), nan=0.0)
            three = self._look_up(self.model.threes, short & np.uint32(0xFFFFFF))
            lower = self.model.pair_weights[(short >> np.uint32(8)) & np.uint32(0xFFFF)] + self.model.twos[short & np.uint32(0xFFFF)]
            logs[unseen] = weight + np.where(np.isnan(three), lower, three)
        bits = min(24, len(codes).bit_length() + 3)
        index = np.zeros(1 << bits, np.int32)
        index[(codes * np.uint32(MULTIPLIER)) >> np.uint32(32 - bits)] = np.arange(len(codes))
        return Known(codes, logs, index, np.uint32(32 - bits))

    def bits(self, data: np.ndarray, offsets: np.ndarray, known: Known | None = None) -> np.ndarray:
        """-log2 of the probability of each row."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(rows)
        logs = (known or self.known([(0, offsets, data)])).of(gram_codes(data, offsets))
        return -row_sums(logs.astype(np.float64), np.repeat(np.arange(rows), np.diff(offsets)), rows)
