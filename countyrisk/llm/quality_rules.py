"""Quality rules: counts of words, symbols and repeats, and bands of perplexity.

A document fails the base rules when it has under 20 words, or when over 30 % of its words
stand in 8-word windows found twice or more. Of the others, those whose perplexity under the
n-gram model of the whole corpus leaves the band of their language are rejected: too high is
noise, too low is text without content. The bands come from all documents of the language
that pass the base rules: the median of the bits per byte, plus and minus so many scaled median
deviations, wider for short texts, whose mean is less certain. Medians are read off a
histogram of ``BIN`` bits, so that they are exact to one bin and the same in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .language_model import Model, Scorer, fit_model
from .lengths import written
from .text import Powers, byte_blocks, byte_table, gram_hashes, mixed, prefix_hashes, row_sums, span_hashes, word_spans

MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"
BIN = 0.001
UPPER_WIDTH, LOWER_WIDTH = 5.0, 6.0
LEAST_DEVIATION = 0.02
SHORT_TEXT = 2.0
FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes")


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys stand more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def own_keys(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return mixed(hashes ^ (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def block_facts(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, tables: Powers) -> list[np.ndarray]:
    """The columns FACTS of each row of a block."""
    rows = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    n_words = np.bincount(owner, minlength=rows)
    byte_owner = np.repeat(np.arange(rows), np.diff(offsets))
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    n_symbols = row_sums(symbol[data], byte_owner, rows)
    # code points in words: those that start there
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_chars = row_sums(leads[ends] - leads[starts], owner, rows)
    prefix = prefix_hashes(data, table, tables)
    words = span_hashes(prefix, starts, ends, tables)

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    following = np.append(line_starts[1:], len(data))
    line_ends = np.where(data[following - 1] == 0x0A, following - 1, following) if len(line_starts) else line_starts
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    keys = own_keys(span_hashes(prefix, line_starts[with_word], line_ends[with_word], tables), line_owner[with_word])
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    n_dup_lines = np.bincount(line_owner[with_word][~first], minlength=rows)

    n_repeat = np.zeros(rows, np.int64)
    windows, window_owner = gram_hashes(words, owner, WINDOW)
    if len(windows):
        twice = repeated(own_keys(windows, window_owner))
        if twice.any():
            inside = owner[: len(words) - WINDOW + 1] == owner[WINDOW - 1 :]
            at = np.flatnonzero(inside)[twice]
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + WINDOW, -1)
            n_repeat = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=rows)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat, np.diff(offsets)]


def batch_facts(column: pa.Array, scorer: Scorer, table: np.ndarray, tables: Powers) -> list[np.ndarray]:
    """FACTS and ``bits`` of each row of a batch."""
    parts: list[list[np.ndarray]] = [[] for _ in range(len(FACTS) + 1)]
    blocks = list(byte_blocks(column))
    known = scorer.known(blocks)
    for _, offsets, data in blocks:
        for part, values in zip(parts, [*block_facts(data, offsets, table, tables), scorer.bits(data, offsets, known)], strict=True):
            part.append(values)
    kinds = [np.int64] * len(FACTS) + [np.float64]
    return [np.concatenate(p).astype(k) if p else np.zeros(0, k) for p, k in zip(parts, kinds, strict=True)]


def text_facts(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang``, FACTS and ``rate`` (bits per byte) of every row."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, table, tables = Scorer(model), byte_table(), Powers()
        for batch in batches:
            columns = batch_facts(batch.column(2), scorer, table, tables)
            rate = columns[-1] / np.maximum(columns[-2], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c) for c in columns[:-1]), pa.array(rate)], names=["doc_id", "lang", *FACTS, "rate"]
            )

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    return chosen.mapInArrow(measured, f"doc_id long, lang string, {', '.join(f'{c} long' for c in FACTS)}, rate double")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _median(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Median per language, from the histogram of bins."""
    bins = rows.groupBy("lang", F.round(value / BIN).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    whole = F.sum("n").over(Window.partitionBy("lang"))
    half = bins.select("lang", "bin", upto.alias("upto"), whole.alias("whole")).where("2 * upto >= whole")
    return half.groupBy("lang").agg((F.min("bin") * BIN).alias(name))


def fit_bands(facts: DataFrame) -> DataFrame:
    """``lang, middle, deviation``: one row per language of the documents that pass the base rules."""
    good = facts.where(~base_failed()).select(F.coalesce("lang", F.lit("")).alias("lang"), "rate")
    middle = written(_median(good, F.col("rate"), "middle"), "bands-middle")
    spread = _median(good.join(middle, "lang"), F.abs(F.col("rate") - F.col("middle")), "apart")
    scaled = F.greatest(F.col("apart") * 1.4826, F.lit(LEAST_DEVIATION))
    return written(middle.join(spread, "lang").select("lang", "middle", scaled.alias("deviation")), "bands")


def judged(facts: DataFrame, bands: DataFrame) -> DataFrame:
    """``facts`` with ``base_failed``, ``perplexity`` (per byte), its band, and ``kept``."""
    known = bands.select(F.col("lang").alias("band_lang"), "middle", "deviation")
    joined = facts.join(known, F.coalesce("lang", F.lit("")) == F.col("band_lang"), "left")
    slack = F.lit(SHORT_TEXT) / F.sqrt(F.greatest("n_bytes", F.lit(1)))
    low = F.col("middle") - LOWER_WIDTH * F.col("deviation") - slack
    high = F.col("middle") + UPPER_WIDTH * F.col("deviation") + slack
    within = F.coalesce(F.col("rate").between(low, high), F.lit(True))
    return joined.withColumns(
        {
            "base_failed": base_failed(),
            "perplexity": F.pow(F.lit(2.0), "rate"),
            "perplexity_low": F.pow(F.lit(2.0), low),
            "perplexity_high": F.pow(F.lit(2.0), high),
            "kept": ~base_failed() & within,
        }
    ).drop("band_lang", "middle", "deviation")


def measure_quality(docs: DataFrame) -> DataFrame:
    """The judged facts of every row: ``doc_id``, counts, ``base_failed``, ``kept`` and the perplexity.

    A null text counts as empty and fails the base rules. A null language is one of its own.
    Repeated rows are judged each; other columns are left out; an empty table gives no rows."""
    facts = written(text_facts(docs, fit_model(docs)), "quality-facts")
    return judged(facts, fit_bands(facts))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, in the same columns.

    The bands need a first pass over all texts; the second one measures again and drops rows
    where they are, so no text is shuffled and null or repeated ids do no harm."""
    model = fit_model(docs)
    facts = written(text_facts(docs, model), "quality-facts")
    bands = fit_bands(facts)
    names = docs.columns
    # a text that stands in the row as it is doesn't go to Python a second time
    inside = [k for k, f in enumerate(docs.schema) if f.name == "text" and isinstance(f.dataType, StringType)]
    inner = docs.select(
        F.struct(*names).alias("row"),
        *([] if inside else [F.col("text").cast("string").alias("text")]),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
    )
    known = bands.select(
        F.col("lang").alias("band_lang"),
        (F.col("middle") - LOWER_WIDTH * F.col("deviation")).alias("low"),
        (F.col("middle") + UPPER_WIDTH * F.col("deviation")).alias("high"),
    )
    ready = inner.join(known, F.col("lang") == F.col("band_lang"), "left").select("row", "low", "high", *([] if inside else ["text"]))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, table, tables = Scorer(model), byte_table(), Powers()
        for batch in batches:
            n_words, _, _, _, n_repeat, n_bytes, bits = batch_facts(batch.column(0).field(inside[0]) if inside else batch.column(3), scorer, table, tables)
            rate, slack = bits / np.maximum(n_bytes, 1), SHORT_TEXT / np.sqrt(np.maximum(n_bytes, 1))
            low = batch.column(1).fill_null(-np.inf).to_numpy() - slack
            high = batch.column(2).fill_null(np.inf).to_numpy() + slack
            good = (n_words >= MIN_WORDS) & (100 * n_repeat <= MAX_REPEAT_PERCENT * n_words) & (rate >= low) & (rate <= high)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good))], names=["row"])

    return ready.mapInArrow(kept, ready.select("row").schema).select("row.*")


def quality_report(docs: DataFrame) -> DataFrame:
    """The registered form of :func:`measure_quality`."""
    return measure_quality(docs).select("doc_id", *FACTS[:5], "base_failed", "kept", "perplexity", "perplexity_low", "perplexity_high")
