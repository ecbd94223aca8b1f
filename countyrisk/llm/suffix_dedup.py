"""Removal of long repeated byte strings, by sorting and induction over anchored suffixes.

A full suffix array of all bytes would take some 15 bytes of tuples a byte and sort pass, far
beyond the disk the job may use, so the recursion of induced sorting starts one level down. The
role of its sampled suffixes is played by anchors: in every run of ``REACH`` positions the one
whose 16 bytes hash lowest. Every string of ``LENGTH`` bytes holds an anchor less than REACH
after its start, chosen from the string alone, so equal strings have anchors at equal places,
and the ``CORE`` bytes from there are equal as well.

1. Anchors with a core that stands nowhere else are dropped (a count over hashes).
2. Of the rest, those with equal surroundings (all bytes that any string over this anchor could
   touch) are settled at once: all these strings repeat. One of each kind goes on.
3. A core with more than ``SORTED`` kinds is split by more bytes: the strings that start in the nearer
   half of REACH hold the bytes behind the core, those from the farther half the bytes in front of
   it, so each half has longer cores of its own. Kinds that are alone with one are out, kinds with all
   the same bytes are settled, the others go on, and halves are halved again while they are too many.
4. The kinds of one core are then sorted as suffix tuples (Spark's external sort brings the cores
   together, spilling to disk as it needs), with the common prefix of neighbours, and strings
   that start d bytes before their anchor are induced from those d-1 before: their class is the
   class one byte later, split by the byte in front, and two of one class are equal when the
   common prefix behind the anchor has LENGTH - d bytes. This compares bytes, not hashes.

Rows are told apart by id and text hash; equal hashes of two different 64-bit functions stand
for equal bytes where kinds are settled (steps 2 and 3).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lengths import written
from .text import Powers, byte_blocks, byte_table, mixed, prefix_hashes, span_hashes

LENGTH = 400
REACH = 160
GRAM = 16
SORTED = 256
FLUSH = 16_384
NO_ID = -(2**63)


def low_anchors(keys: np.ndarray, offsets: np.ndarray, length: int, reach: int) -> np.ndarray:
    """Place of the lowest key (the first of equal ones) in the ``reach`` places from each start
    of a string of ``length`` bytes that stays in its row; distinct and in order."""
    n = len(keys)
    low = (keys & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    span = 1
    while 2 * span <= reach:
        low = np.minimum(low[: len(low) - span], low[span:]) if len(low) > span else low[:0]
        span *= 2
    if reach > span:
        shift = reach - span
        low = np.minimum(low[: len(low) - shift], low[shift:]) if len(low) > shift else low[:0]
    starts = np.zeros(n + 1, np.int32)
    first, last = offsets[:-1], offsets[1:] - length + 1
    long = last > first
    starts[first[long]] += 1
    starts[last[long]] -= 1
    valid = np.cumsum(starts[:n]) > 0
    valid = valid[: len(low)]
    return np.unique(low[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def block_anchors(data: np.ndarray, offsets: np.ndarray, length: int, reach: int, tables: Powers, ways: list[np.ndarray]) -> list[np.ndarray]:
    """row, place in it, bytes before and after, hash of the core, two hashes of the surroundings."""
    prefix = prefix_hashes(data, ways[0], tables)
    at = np.arange(len(data))
    grams = span_hashes(prefix, at, np.minimum(at + GRAM, len(data)), tables)
    anchors = low_anchors(grams, offsets, length, reach)
    rows = np.searchsorted(offsets, anchors, "right") - 1
    before = np.minimum(reach - 1, anchors - offsets[rows])
    after = np.minimum(length, offsets[rows + 1] - anchors)
    core = span_hashes(prefix, anchors, anchors + length - reach + 1, tables)
    extent = (before * (length + 1) + after).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    around = mixed(span_hashes(prefix, anchors - before, anchors + after, tables) + extent)
    other = prefix_hashes(data, ways[1], tables)
    again = mixed(span_hashes(other, anchors - before, anchors + after, tables) ^ extent)
    return [rows, anchors - offsets[rows], before, after, core.view(np.int64), around.view(np.int64), again.view(np.int64)]


ANCHOR = ("id", "text_hash", "place", "before", "after", "core", "around", "again")


def find_anchors(texts: DataFrame, length: int, reach: int) -> DataFrame:
    """ANCHOR columns of every anchor of every text (``id``, ``text_hash``, ``text``)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, ways = Powers(), [byte_table(1), byte_table(2)]
        for batch in batches:
            for at, offsets, data in byte_blocks(batch.column(2)):
                if len(data) < length:
                    continue
                rows, *rest = block_anchors(data, offsets, length, reach, tables, ways)
                take = pa.array(rows + at)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *(pa.array(c) for c in rest)], names=list(ANCHOR))

    return texts.drop("doc_id").mapInArrow(found, ", ".join(f"{c} long" for c in ANCHOR))


def repeated_starts(
    strings: list[bytes], before: np.ndarray, after: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, reach: int
) -> np.ndarray:
    """rows x reach: whether the string that starts d bytes before the anchor of a row stands
    under another row too. ``strings`` are the bytes around the anchors; a row has the starts from ``low`` to ``high``."""
    n = len(strings)
    out = np.zeros((n, reach), bool)
    wide = np.zeros((n, reach - 1 + length), np.uint8)
    for k, text in enumerate(strings):
        wide[k, reach - 1 - before[k] : reach - 1 + after[k]] = np.frombuffer(text, np.uint8)
    right = np.ascontiguousarray(wide[:, reach - 1 :])
    order = np.argsort(right.view(f"S{length}").ravel(), kind="stable")
    differs = right[order[1:]] != right[order[:-1]]
    common = np.where(differs.any(1), differs.argmax(1), length) if n > 1 else np.zeros(0, np.int64)
    common = np.minimum(common, np.minimum(after[order[1:]], after[order[:-1]])) if n > 1 else common
    left = np.zeros(n, np.int64)
    for d in range(reach):
        if d:
            # the class one byte later and the byte in front give the class
            left = np.unique(left * 256 + wide[:, reach - 1 - d], return_inverse=True)[1]
        behind = np.zeros(n, np.int64)
        behind[order[1:]] = np.cumsum(common < length - d)
        live = np.flatnonzero((before >= d) & (after >= length - d) & (low <= d) & (d <= high))
        if len(live) < 2:
            continue
        key = left[live] * n + behind[live]
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            out[live, d] = twice[at] == key
    return out


def start_runs(flags: np.ndarray, place: int, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the repeated strings of one anchor."""
    d = np.flatnonzero(flags)
    if not len(d):
        return []
    cuts = np.flatnonzero(np.diff(d) > 1)
    firsts, lasts = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(d) - 1]])
    return [(int(place - d[b]), int(place - d[a] + length)) for a, b in zip(firsts, lasts, strict=True)]


def covered_ranges(docs: DataFrame, length: int = LENGTH, reach: int = REACH, most: int = SORTED) -> tuple[DataFrame, DataFrame]:
    """(texts with ``id`` and ``text_hash``, ranges ``id, text_hash, start, end``): every byte in a
    string of ``length`` bytes that also starts elsewhere is in a range."""
    if not 2 * reach <= length:
        raise ValueError("reach is at most half the length")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")
    )
    anchors = written(find_anchors(texts, length, reach), "anchors")
    # counted cores are written, so that both sides of the joins are plain shuffles, which can be
    # split where one core is hot
    cores = written(anchors.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "cores")
    met = written(anchors.join(cores, "core", "left_semi"), "anchors-met")
    kinds = met.groupBy("core", "around", "again").agg(F.count("*").alias("n"), F.min(F.struct("id", "text_hash", "place", "before", "after")).alias("one"))
    kinds = written(kinds, "kinds")
    settled = met.join(kinds.where("n > 1").select("core", "around", "again"), ["core", "around", "again"], "left_semi")
    ranges = settled.select("id", "text_hash", (F.col("place") - F.col("before")).alias("start"), (F.col("place") + F.col("after")).alias("end"))

    several = written(kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1"), "cores")
    wanted = kinds.join(several, "core").select("core", "n", "kinds", "one.*")
    by_row = wanted.groupBy("id", "text_hash").agg(F.collect_list(F.struct("core", "n", "kinds", "place", "before", "after")).alias("wanted"))
    around = written(cut_out(texts.join(by_row, ["id", "text_hash"])), "around")
    around = around.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(reach - 1).cast("long")})
    while True:
        # rows of one id and text are cut out of each; one is enough
        few = around.where(F.col("kinds") <= most).repartition("core").sortWithinPartitions("core", "id", "text_hash", "place")
        ranges = ranges.unionByName(induced(few, length, reach))
        many = around.where(F.col("kinds") > most)
        if many.isEmpty():
            return texts, ranges
        found, around = split_cores(many, length)
        ranges = ranges.unionByName(found)


def split_cores(many: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(ranges that are settled, the kinds of the longer cores) of kinds with starts from ``low`` to ``high``."""
    halves = written(halved(many, length), "halves")
    alike = ["core", "whole", "again"]
    same = written(halves.groupBy(*alike).agg(F.count("*").alias("same")), "wholes")
    cores = same.groupBy("core").agg(F.sum("same").alias("rows"), F.count("*").alias("kinds")).where("rows > 1")
    first, last = F.least("before", "high"), F.greatest("low", F.lit(length) - F.col("after"))
    settled = halves.where("n = 1").join(same.where("same > 1").select(*alike), alike, "left_semi")
    found = settled.select("id", "text_hash", (F.col("place") - first).alias("start"), (F.col("place") - last + length).alias("end"))
    one = Window.partitionBy(*alike).orderBy("id", "text_hash", "place")
    kinds = halves.withColumn("row", F.row_number().over(one)).where("row = 1").drop("row", "kinds")
    kinds = kinds.join(same, alike).join(cores.where("kinds > 1").select("core", "kinds"), "core")
    kinds = kinds.select("id", "text_hash", "core", F.greatest("n", "same").alias("n"), "kinds", "place", "before", "after", "around", "low", "high")
    return found, written(kinds, "around")


CUT = "id long, text_hash long, core long, n long, kinds long, place long, before long, after long, around binary"


def cut_out(texts: DataFrame) -> DataFrame:
    """The bytes around every wanted anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = (batch.column(2)[row].as_py() or "").encode()
                wanted = batch.column(3)[row].as_py()
                columns = [[w[c] for w in wanted] for c in ("core", "n", "kinds", "place", "before", "after")]
                around = [text[w["place"] - w["before"] : w["place"] + w["after"]] for w in wanted]
                ids = [pa.array([batch.column(c)[row].as_py()] * len(wanted), pa.int64()) for c in (0, 1)]
                arrays = [*ids, *(pa.array(c, pa.int64()) for c in columns), pa.array(around, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "text_hash", "core", "n", "kinds", "place", "before", "after", "around"])

    return texts.select("id", "text_hash", "text", "wanted").mapInArrow(cut, CUT)


HALF = "id long, text_hash long, core long, n long, place long, before long, after long, around binary, low long, high long, whole long, again long"


def halved(many: DataFrame, length: int) -> DataFrame:
    """Each row once for either half of its starts that has a string: with the hash of the bytes that all
    strings of the half hold (``core``), and two of all bytes that any of them could touch."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, ways = Powers(), [byte_table(1), byte_table(2)]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                strings = part.column(6).to_pylist()
                data = np.frombuffer(b"".join(strings), np.uint8)
                core, before, after, low, high = (part.column(c).to_numpy() for c in (2, 4, 5, 7, 8))
                sizes = np.array([len(t) for t in strings], np.int64)
                anchor = np.cumsum(sizes) - sizes + before
                prefixes = [prefix_hashes(data, way, tables) for way in ways]
                middle = (low + high + 1) // 2
                for first, last in ((low, middle - 1), (middle, high)):
                    # a single start has no nearer half
                    some = np.flatnonzero((first <= last) & (before >= first) & (after >= length - last))
                    a, first, last = anchor[some], first[some], last[some]
                    own = mixed(core[some].view(np.uint64) ^ mixed((first * length + last).astype(np.uint64) + np.uint64(7)))
                    key = mixed(own + span_hashes(prefixes[0], a - first, a + length - last, tables))
                    left, right = np.minimum(before[some], last), np.minimum(after[some], length - first)
                    extent = (left * (length + 1) + right).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    wholes = [mixed(span_hashes(p, a - left, a + right, tables) ^ extent) for p in prefixes]
                    take = pa.array(some)
                    kept = [part.column(c).take(take) for c in (0, 1, 3, 4, 5, 6)]
                    arrays = [kept[0], kept[1], pa.array(key.view(np.int64)), part.column(9).take(take), *kept[2:], pa.array(first), pa.array(last)]
                    yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(w.view(np.int64)) for w in wholes)], names=[c.split()[0] for c in HALF.split(", ")])

    return many.select("id", "text_hash", "core", "place", "before", "after", "around", "low", "high", "n").mapInArrow(cut, HALF)


RANGE = "id long, text_hash long, start long, end long"


def range_batch(ranges: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = np.array(ranges, np.int64).reshape(-1, 4)
    return pa.RecordBatch.from_arrays([pa.array(columns[:, k]) for k in range(4)], names=["id", "text_hash", "start", "end"])


def induced(around: DataFrame, length: int, reach: int) -> DataFrame:
    """Ranges of the strings that repeat among the kinds of one core; ``around`` comes by core."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        before, after, low, high = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 8, 9))
        flags = repeated_starts([r[6] for r in rows], before, after, low, high, length, reach)
        found = [(r[0], r[1], a, b) for r, own in zip(rows, flags, strict=True) if r[7] == 1 for a, b in start_runs(own, r[3], length)]
        return range_batch(found)

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        seen: tuple | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("id", "text_hash", "core", "place", "before", "after", "around", "n", "low", "high")]
            for row in zip(*columns, strict=True):
                if (row[0], row[1], row[2], row[3]) == seen:
                    continue  # a repeated row of one id and text
                if len(held) >= FLUSH and row[2] != held[-1][2]:
                    yield settle(held)
                    held = []
                held.append(row)
                seen = (row[0], row[1], row[2], row[3])
        if held:
            yield settle(held)

    return around.mapInArrow(swept, RANGE)


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that meet or overlap made one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, reach: int = REACH, most: int = SORTED) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: the removed byte ranges and the bytes left.

    A null or empty text, and one shorter than ``length`` bytes, loses nothing. Repeated rows
    repeat each other. Strings are judged on the input, and matches never cross rows. Other
    columns are left out; an empty table gives no rows."""
    texts, ranges = covered_ranges(docs, length, reach, most)
    listed = ranges.groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    whole = texts.join(listed, ["id", "text_hash"], "left").select("doc_id", "text", "ranges")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for row in range(batch.num_rows):
                text = (batch.column(1)[row].as_py() or "").encode()
                own = united([(r["start"], r["end"]) for r in batch.column(2)[row].as_py() or []])
                parts, at = [], 0
                for start, end in own:
                    parts.append(text[at:start])
                    at = end
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in own])
                kept.append(b"".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"]
            )

    return whole.mapInArrow(removed, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def removal_report(docs: DataFrame) -> DataFrame:
    """The registered form of :func:`remove_repeats`: counts, a digest of what is left, and whether bytes went."""
    done = remove_repeats(docs)
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), (F.size("spans") > 0).alias("removed"))

