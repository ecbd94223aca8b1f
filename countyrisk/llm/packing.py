"""Best-fit packing of documents into bins of a fixed number of words, without conflicts.

No bin holds two documents of one source or of one duplicate cluster (the same words in the
same order, A-Z lower-cased). Documents are dealt into shards by a hash of their id, so a hot
source or a large cluster is spread over all shards; each shard is packed on its own, longest
document first. Open bins stand in the order of their residual room. Every bin carries a
bitmap of its sources and clusters, and a tree over the residuals holds what all bins below a
node have in common, so that the successor search passes over runs of bins that can't take
the document and goes on until it meets the tightest compatible one. If there is none, a new
bin is opened: the number of bins has no cap.

A document longer than a bin is cut into pieces; full pieces fill a bin each, the last one is
packed like a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lengths import with_lengths, written

CAPACITY = 2048
SHARD_ROWS = 5_000


class Bins:
    """Open bins by residual room, under a tree of shared bits."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.size = 1
        while self.size < capacity + 1:
            self.size *= 2
        self.shared = [-1] * (2 * self.size)  # no bins: every bit
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.room: list[int] = []
        self.bits: list[int] = []

    def _settle(self, room: int) -> None:
        node = room + self.size
        bits = -1
        for b in self.at[room]:
            bits &= self.bits[b]
        self.shared[node] = bits
        node //= 2
        while node:
            self.shared[node] = self.shared[2 * node] & self.shared[2 * node + 1]
            node //= 2

    def tightest(self, length: int, need: int) -> int | None:
        """The compatible bin with the least room of at least ``length``; ties to the oldest.

        Bit 0 stands for having no bins at all: bins never have it, so empty rooms are passed over."""
        need |= 1
        stack = [(1, 0, self.size - 1)]
        while stack:
            node, low, high = stack.pop()
            if high < length or self.shared[node] & need:
                continue
            if low == high:
                fits = [b for b in self.at[low] if not self.bits[b] & need]
                if fits:
                    return min(fits)
                continue
            middle = (low + high) // 2
            stack += [(2 * node + 1, middle + 1, high), (2 * node, low, middle)]
        return None

    def put(self, length: int, need: int) -> tuple[int, int]:
        """Bin and the place in it."""
        need <<= 1
        found = self.tightest(length, need)
        if found is None:
            found = len(self.room)
            self.room.append(self.capacity)
            self.bits.append(0)
        else:
            self.at[self.room[found]].remove(found)
            self._settle(self.room[found])
        start = self.capacity - self.room[found]
        self.room[found] -= length
        self.bits[found] |= need
        self.at[self.room[found]].append(found)
        self._settle(self.room[found])
        return found, start

    def full(self, need: int) -> int:
        """A new bin that one piece fills."""
        self.room.append(0)
        self.bits.append(need << 1)
        self.at[0].append(len(self.room) - 1)
        return len(self.room) - 1


def pack_rows(lengths: list[int], needs: list[int], order: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(row, piece, length, bin, start) of every piece; ``order`` breaks ties between lengths."""
    bins = Bins(capacity)
    out, rest = [], []
    for row in order:
        whole, last = divmod(lengths[row], capacity)
        out += [(row, piece, capacity, bins.full(needs[row]), 0) for piece in range(whole)]
        if last or not whole:
            rest.append((-last, len(rest), row, whole))
    if rest:
        bins._settle(0)
    for negative, _, row, piece in sorted(rest):
        where, start = bins.put(-negative, needs[row])
        out.append((row, piece, -negative, where, start))
    return out


def conflict_bits(keys: list[object], taken: int) -> tuple[list[int], int]:
    """A bit for every key that stands more than once, none for the others; the next free bit."""
    seen: dict[object, int] = {}
    for key in keys:
        seen[key] = seen.get(key, 0) + 1
    bits = {}
    for key, n in seen.items():
        if n > 1 and key is not None:
            bits[key] = 1 << taken
            taken += 1
    return [bits.get(key, 0) for key in keys], taken


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, piece, n_words, bin_id, start`` of every piece of every row.

    ``bin_id`` is unique over all shards. Rows of one id (repeats) are one cluster as well, so
    they never share a bin. A null source is no conflict; a null or empty text is a piece of no
    words, and such pieces have no cluster. Repeated rows are packed each; ties in length go by
    ``doc_id``; other columns are left out; an empty table gives no rows."""
    # the number makes rows differ that have no id or share one, so that shards are even
    rows = written(with_lengths(docs).withColumn("deal", F.monotonically_increasing_id()), "packing")
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash", "deal"), F.lit(shards)).cast("int"))

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        table = table.sort_by([("doc_id", "ascending"), ("n_words", "ascending"), ("seq_a", "ascending"), ("source", "ascending")])
        ids, lengths = table.column("doc_id").to_pylist(), table.column("n_words").to_pylist()
        pairs = zip(table.column("seq_a").to_pylist(), table.column("seq_b").to_pylist(), lengths, strict=True)
        clusters = [(a, b) if n else None for a, b, n in pairs]
        by_source, taken = conflict_bits(table.column("source").to_pylist(), 0)
        by_cluster, taken = conflict_bits(clusters, taken)
        by_id, _ = conflict_bits(ids, taken)
        needs = [a | b | c for a, b, c in zip(by_source, by_cluster, by_id, strict=True)]
        out = np.array(pack_rows(lengths, needs, list(range(len(ids))), capacity), np.int64).reshape(-1, 5)
        return pa.table(
            {
                "doc_id": table.column("doc_id").combine_chunks().take(pa.array(out[:, 0])),
                "piece": pa.array(out[:, 1]),
                "n_words": pa.array(out[:, 2]),
                "bin_id": pa.array(out[:, 3] + (shard << 32)),
                "start": pa.array(out[:, 4]),
            }
        )

    return dealt.groupBy("shard").applyInArrow(packed, "doc_id long, piece long, n_words long, bin_id long, start long")
