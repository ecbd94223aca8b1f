"""Quality classifier: a factorisation machine over hashed words, structure and length.

Each text has one feature per distinct word (A-Z lower-cased, hashed to 2^16) and a few numbers
on its structure (word lengths, shares of capitals, digits, marks, distinct words, lines) and
size. Every feature has a weight and a vector of ``FACTORS`` numbers; the score adds the
products of all pairs of vectors, in linear time by the identity
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

The machine is fitted with Adam in the driver on a sample of at most 2 x ``PER_CLASS``
labelled rows that aren't held out; the model has a fixed size and is broadcast. All texts are
scored whole, where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import held_out, labelled_texts
from .text import Powers, byte_blocks, byte_table, row_sums, word_hashes, word_spans

PER_CLASS = 2_000
BUCKETS = 1 << 16
FACTORS = 8
EPOCHS = 12
BATCH = 64
RATE = 0.02
THRESHOLD = 0.7
MARKS = (b"!", b"|", b"#*$%&<>~^", b".,;:?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n")
NUMBERS = 6 + len(MARKS)


class Sparse(NamedTuple):
    """Features of some rows: row (in order), index and value of each entry."""

    rows: np.ndarray
    index: np.ndarray
    value: np.ndarray


class Machine(NamedTuple):
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    prior: float | None  # set when there was nothing to learn


def block_features(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, tables: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row and bucket of every distinct word, numbers of every row)."""
    rows = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends, table, tables)
    pairs = np.unique((owner.astype(np.uint64) << np.uint64(16)) | (hashes >> np.uint64(48)))
    word_row, bucket = (pairs >> np.uint64(16)).astype(np.int64), (pairs & np.uint64(0xFFFF)).astype(np.int64)

    byte_owner = np.repeat(np.arange(rows), np.diff(offsets))
    size = np.diff(offsets).astype(np.float64)
    n_words = np.bincount(owner, minlength=rows).astype(np.float64)
    lengths = (ends - starts).astype(np.float64)
    mean = row_sums(lengths, owner, rows) / np.maximum(n_words, 1)
    deviation = np.sqrt(np.maximum(row_sums(lengths**2, owner, rows) / np.maximum(n_words, 1) - mean**2, 0))
    again = np.zeros(len(hashes), np.float64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    numbers = [
        np.log1p(size),
        np.log1p(n_words),
        mean,
        deviation,
        np.bincount(word_row, minlength=rows) / np.maximum(n_words, 1) ** 0.9,
        row_sums(again, owner, rows) / np.maximum(n_words, 1),
    ]
    for mark in MARKS:
        flags = np.zeros(256, np.float64)
        flags[list(mark)] = 1
        numbers.append(np.log1p(20 * row_sums(flags[data], byte_owner, rows) / np.maximum(size, 1)))
    return word_row, bucket, np.stack(numbers, 1)


def sparse_rows(word_row: np.ndarray, bucket: np.ndarray, numbers: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> Sparse:
    """Words with equal values of norm 1, then the numbers, centred and cut at three deviations."""
    rows = len(numbers)
    counts = np.bincount(word_row, minlength=rows)
    values = 1 / np.sqrt(np.maximum(counts, 1))
    scaled = np.clip((numbers - centre) / spread, -3, 3) / 3
    row = np.concatenate([word_row, np.repeat(np.arange(rows), NUMBERS)])
    order = np.argsort(row, kind="stable")
    index = np.concatenate([bucket, np.tile(np.arange(BUCKETS, BUCKETS + NUMBERS), rows)])
    value = np.concatenate([values[word_row], scaled.ravel()])
    return Sparse(row[order], index[order], value[order])


def raw_scores(machine: Machine, x: Sparse, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Score before the logistic function, and the sums of the factors."""
    total = machine.bias + row_sums(machine.weights[x.index] * x.value, x.rows, rows)
    sums = np.empty((rows, machine.vectors.shape[1]))
    for f in range(machine.vectors.shape[1]):
        part = machine.vectors[x.index, f] * x.value
        sums[:, f] = row_sums(part, x.rows, rows)
        total += 0.5 * (sums[:, f] ** 2 - row_sums(part**2, x.rows, rows))
    return total, sums


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def text_column(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.string())


def gathered(column: pa.Array, table: np.ndarray, tables: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at, offsets, data in byte_blocks(column):
        row, bucket, numbers = block_features(data, offsets, table, tables)
        parts.append((row + at, bucket, numbers))
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(3))  # type: ignore[return-value]


def fit_machine(examples: list[tuple[str, int]], seed: int = 5) -> Machine:
    """The machine of (text, 0 or 1) pairs; with one class or none it always gives the share of ones."""
    labels = np.array([y for _, y in examples], np.float64)
    random = np.random.default_rng(seed)
    size = BUCKETS + NUMBERS
    if not len(labels) or labels.min() == labels.max():
        prior = float(labels.mean()) if len(labels) else 0.5
        return Machine(0.0, np.zeros(size), np.zeros((size, FACTORS)), np.zeros(NUMBERS), np.ones(NUMBERS), prior)
    word_row, bucket, numbers = gathered(text_column([t for t, _ in examples]), byte_table(lower=True), Powers())
    centre, spread = numbers.mean(0), np.maximum(numbers.std(0), 1e-3)
    x = sparse_rows(word_row, bucket, numbers, centre, spread)
    edges = np.searchsorted(x.rows, np.arange(len(labels) + 1))
    bias = float(np.log(labels.mean() / (1 - labels.mean())))
    weights, vectors = np.zeros(size), random.normal(0, 0.05, (size, FACTORS))
    # one row of Adam's moments per feature: weight, then vector
    values = np.concatenate([weights[:, None], vectors], 1)
    first, second, step = np.zeros_like(values), np.zeros_like(values), 0
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(labels)), max(1, len(labels) // BATCH)):
            spans = [np.arange(edges[r], edges[r + 1]) for r in rows]
            take = np.concatenate(spans)
            local = Sparse(np.repeat(np.arange(len(rows)), [len(s) for s in spans]), x.index[take], x.value[take])
            raw, sums = raw_scores(Machine(bias, values[:, 0], values[:, 1:], centre, spread, None), local, len(rows))
            slope = (logistic(raw) - labels[rows]) / len(rows)
            step += 1
            bias -= RATE * float(slope.sum())
            touched, inverse = np.unique(local.index, return_inverse=True)
            pull = slope[local.rows] * local.value
            grown = np.empty((len(touched), FACTORS + 1))
            grown[:, 0] = np.bincount(inverse, pull, len(touched))
            for f in range(FACTORS):
                own = values[local.index, f + 1] * local.value
                grown[:, f + 1] = np.bincount(inverse, pull * (sums[local.rows, f] - own), len(touched))
            grown += 1e-4 * values[touched]
            first[touched] = 0.9 * first[touched] + 0.1 * grown
            second[touched] = 0.99 * second[touched] + 0.01 * grown**2
            values[touched] -= RATE * (first[touched] / (1 - 0.9**step)) / (np.sqrt(second[touched] / (1 - 0.99**step)) + 1e-8)
    return Machine(bias, values[:, 0].astype(np.float32), values[:, 1:].astype(np.float32), centre, spread, None)


def machine_scores(machine: Machine, column: pa.Array, table: np.ndarray, tables: Powers) -> np.ndarray:
    out = []
    for _, offsets, data in byte_blocks(column):
        word_row, bucket, numbers = block_features(data, offsets, table, tables)
        x = sparse_rows(word_row, bucket, numbers, machine.centre, machine.spread)
        out.append(logistic(raw_scores(machine, x, len(offsets) - 1)[0]))
    scores = np.concatenate(out) if out else np.zeros(0)
    return scores if machine.prior is None else np.full(len(scores), machine.prior)


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null texts are scored as empty ones; rows without a label are scored all the same; a null
    id isn't held out; repeated rows are scored each; other columns are left out; an empty
    table gives no rows; without labels of both classes every score is the share of ones (0.5
    without any)."""
    machine = docs.sparkSession.sparkContext.broadcast(fit_machine(labelled_texts(docs, labels, "quality", per_class)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables = byte_table(lower=True), Powers()
        for batch in batches:
            scores = machine_scores(machine.value, batch.column(2), table, tables)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), predicted], names=["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
