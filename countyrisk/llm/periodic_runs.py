"""Periodic runs of words in whole texts, by pattern matching inside the text.

A run is a stretch of words with smallest period q, at least ``repeats`` (four) times as long as q,
that can't be extended. Let 2^k be the smallest power of two that is at least q (and two): a run
has an aligned block of 2^k words, and behind or in front of it there is room for one more period.
The block holds a whole period, so no occurrence of it in the run is nearer than q, and the next
or the last one is exactly q away. Hence for every aligned (dyadic) block of every size two
queries are enough: its next and its last occurrence, if they are in the window of 2^k words beside
it. Occurrences in such a window form a progression, whose difference is the candidate period.

The suffix array is built by doubling, many texts at a time; only groups that aren't single yet are
sorted again. The suffixes that begin with a block are a slice of the array, and a wavelet tree over
the array answers which position of a slice comes next: two walks down the bits, for all
blocks at once. Candidates are extended to both sides by the names that doubling gave to words 2^j
long, which is exact, and those that are long enough are runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import Powers, byte_blocks, byte_table, mixed, word_hashes, word_spans

REPEATS = 4
LEAST = 6
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def group_heads(keys: np.ndarray) -> np.ndarray:
    """For each entry of sorted ``keys`` the place of the first entry that equals it."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


class Suffixes:
    """Suffix array of many texts, none of which sees another's words.

    ``names[k]`` numbers the words i … i + 2^k - 1 of each position by the place of the first suffix
    that begins with them; ``slices[k]`` are the aligned blocks of 2^k words that occur again."""

    def __init__(self, words: np.ndarray, owner: np.ndarray, edges: np.ndarray):
        count = len(words)
        begin, self.end = edges[owner], edges[owner + 1]
        keys = mixed(words + mixed(owner.astype(np.uint64) + np.uint64(1)))
        self.array = np.argsort(keys, kind="stable")
        heads = group_heads(keys[self.array])
        rank = np.empty(count, np.int64)
        rank[self.array] = heads
        self.names, self.slices, step = [rank.astype(np.int32)], [], 1
        sizes = np.bincount(rank, minlength=count)
        open_ = np.flatnonzero(sizes[heads] > 1)
        self.repeated = open_
        while len(open_):
            at = self.array[open_]
            onward = at + step
            inside = onward < self.end[at]
            second = np.where(inside, rank[np.minimum(onward, count - 1)] + 1, 0)
            keys = rank[at] * (count + 1) + second
            order = np.argsort(keys, kind="stable")
            self.array[open_] = at[order]
            heads = open_[group_heads(keys[order])]
            rank[self.array[open_]] = heads
            sizes = np.bincount(heads, minlength=count)
            step *= 2
            open_ = open_[sizes[heads] > 1]
            if step == 2:
                self.repeated = open_
            at = self.array[open_]
            at = at[((at - begin[at]) % step == 0) & (at + step <= self.end[at])]
            self.slices.append((step, at, rank[at], rank[at] + sizes[rank[at]]))
            self.names.append(rank.astype(np.int32))

    def extensions(self, one: np.ndarray, two: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words from ``one`` and ``two`` (behind it) on are the same, and how many in front of them."""
        ahead, back = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
        last, end = len(self.end) - 1, self.end[one]
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            far = two + ahead
            same = (far < end) & (names[np.minimum(one + ahead, last)] == names[np.minimum(far, last)])
            ahead[same] += 1 << k
            left, right = one - back - (1 << k), two - back - (1 << k)
            same = (left >= begin) & (names[np.maximum(left, 0)] == names[np.maximum(right, 0)])
            back[same] += 1 << k
        return ahead, back


class Wavelet:
    """Wavelet tree (as a matrix of bit counts) over an array of numbers below 2^bits."""

    def __init__(self, values: np.ndarray, bits: int):
        self.zeros: list[tuple[int, np.ndarray, int]] = []
        for bit in range(bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=before[1:])
            self.zeros.append((bit, before, int(before[-1])))
            values = np.concatenate([values[low], values[~low]])

    def count_below(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many entries of each slice are below its limit."""
        low, high, found = low.copy(), high.copy(), np.zeros(len(low), np.int64)
        for bit, before, zeros in self.zeros:
            a, b = before[low], before[high]
            one = (limit >> bit) & 1 == 1
            found += np.where(one, b - a, 0)
            low, high = np.where(one, low - a + zeros, a), np.where(one, high - b + zeros, b)
        return found

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest entry of each slice, from 0."""
        low, high, n, value = low.copy(), high.copy(), n.copy(), np.zeros(len(low), np.int64)
        for bit, before, zeros in self.zeros:
            a, b = before[low], before[high]
            one = n >= b - a
            value += np.where(one, 1 << bit, 0)
            n -= np.where(one, b - a, 0)
            low, high = np.where(one, low - a + zeros, a), np.where(one, high - b + zeros, b)
        return value


def candidates(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(position, period): the block there occurs again a period later."""
    nothing = np.zeros(0, np.int64)
    if not any(len(at) for _, at, _, _ in suffixes.slices):
        return nothing, nothing
    # single suffixes answer no query, so the tree has the others only
    packed = np.zeros(len(suffixes.array) + 1, np.int64)
    packed[suffixes.repeated + 1] = 1
    np.cumsum(packed, out=packed)
    tree = Wavelet(suffixes.array[suffixes.repeated], len(suffixes.array).bit_length())
    places, periods = [], []
    for step, at, low, high in suffixes.slices:
        low, high = packed[low], packed[high]
        before = tree.count_below(low, high, at)
        for rank, sign in ((before + 1, 1), (before - 1, -1)):
            some = (rank >= 0) & (rank < high - low)
            own = at[some]
            apart = sign * (tree.nth(low[some], high[some], rank[some]) - own)
            near = apart <= step
            places.append(own[near] if sign > 0 else own[near] - apart[near])
            periods.append(apart[near])
    return np.concatenate(places), np.concatenate(periods)


def runs_of(words: np.ndarray, owner: np.ndarray, edges: np.ndarray, repeats: int, least: int) -> np.ndarray:
    """Rows of (text, start, length, period), by text, start, then period.

    ``words`` are hashes, ``owner`` the text of each, ``edges`` the first word of each text."""
    if not len(words):
        return np.zeros((0, 4), np.int64)
    suffixes = Suffixes(words, owner, edges)
    at, period = candidates(suffixes)
    begin = edges[owner[at]]
    ahead, back = suffixes.extensions(at, at + period, begin)
    start, length = at - back, back + ahead + period
    long = length >= np.maximum(least, repeats * period)
    found = np.stack([owner[at], start - begin, length, period], 1)[long]
    # a stretch that was met with multiples of its period, too
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(1)
    found = found[new]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def find_runs(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs`` (``doc_id``, ``text``).

    ``runs`` are the runs of at least ``least`` words and ``repeats`` (four or more) periods, by start,
    then period; words are numbered from 0. ``collapsed`` is the text with one space between words and without
    the words that are behind the first period of a run. Texts that are null or have no words give no runs
    and an empty text. Ids may be null or repeat; other columns are left out; an empty table gives no rows."""
    if repeats < 4:
        raise ValueError("fewer than four repeats need larger windows")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables = byte_table(), Powers()
        for batch in batches:
            for at, offsets, data in byte_blocks(batch.column(1)):
                count = len(offsets) - 1
                starts, ends, owner = word_spans(data, offsets)
                edges = np.searchsorted(owner, np.arange(count + 1))
                rows = runs_of(word_hashes(data, starts, ends, table, tables), owner, edges, repeats, least)
                turns = np.zeros(len(starts) + 1, np.int64)
                np.add.at(turns, edges[rows[:, 0]] + rows[:, 1] + rows[:, 3], 1)
                np.add.at(turns, edges[rows[:, 0]] + rows[:, 1] + rows[:, 2], -1)
                kept = np.flatnonzero(np.cumsum(turns[:-1]) == 0)
                bounds = np.searchsorted(kept, edges)
                whole, firsts, lasts = data.tobytes(), starts[kept].tolist(), ends[kept].tolist()
                texts = [
                    b" ".join([whole[a:b] for a, b in zip(firsts[low:high], lasts[low:high], strict=True)])
                    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                ]
                each = np.searchsorted(rows[:, 0], np.arange(count + 1)).astype(np.int32)
                parts = [pa.array(np.ascontiguousarray(rows[:, k])) for k in (1, 2, 3)]
                runs = pa.ListArray.from_arrays(pa.array(each), pa.StructArray.from_arrays(parts, names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, count), pa.array(np.diff(edges)), runs, pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(found, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def with_planted_tail(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of all documents, chosen by a checksum of the id, the words from
    some place on repeat with some period. Texts without words and rows without an id stay."""
    checksum = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    text = F.col("text").cast("string")
    found, lot = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.floor(checksum / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        first = lot % n
        period = 1 + F.floor((n - first) / (3 + lot % 8))
        source = lambda place: F.when(place < first, place).otherwise(first + (place - first) % period)
        return F.array_join(F.transform(words, lambda word, place: F.get(words, source(place).cast("int"))), " ")

    # as a variable of a function the words are found once a text, not once a word
    tail = F.transform(F.array(found), repeated)[0]
    chosen = docs.select("doc_id", "text").withColumn("chosen", F.coalesce((checksum % 10 == 0) & text.rlike(WORD), F.lit(False)))
    return chosen.select("doc_id", F.when(F.col("chosen"), tail).otherwise(text).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """The contract's columns of :func:`find_runs`: counts, the longest run and digests."""
    best = F.expr("array_sort(runs, (a, b) -> CASE WHEN a.length != b.length THEN int(sign(b.length - a.length)) WHEN a.start != b.start THEN int(sign(a.start - b.start)) ELSE int(sign(a.period - b.period)) END)[0]")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def run_report(docs: DataFrame, planted: bool = False) -> DataFrame:
    """The registered form of :func:`find_runs`, over documents with planted tails or as they are."""
    return run_digest(find_runs(with_planted_tail(docs) if planted else docs))
