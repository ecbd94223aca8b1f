"""URL rules held in a sorted array of digests.

A rule is a host and a path. It fits the host and every subdomain of it when the path of the
URL starts with the path of the rule; the longest rule that fits decides. Rules are kept as
one file: sorted 64-bit xxhash keys, the place of each stored string, verdict flags, and the
strings. Spark ships the file to every executor, where tasks map it into memory (workers of
one machine share the pages), probe it with a vectorised binary search for every host suffix
and path prefix of a batch of URLs, and compare the stored string of each hit, so that two
strings with one digest are told apart.

The file is made in the driver, so the rule list has a stated bound, ``MAX_RULES``; a longer
list is refused. URLs are never shuffled, so a host with a third of all pages costs nothing
extra.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

MAX_RULES = 5_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def pack_rules(rules: Iterable[Rule]) -> bytes:
    """The file: counts and path lengths, then keys, string ends, verdicts (1 block), strings.

    Of two rules with the same host and path the blocking one holds."""
    chosen: dict[str, bool] = {}
    for rule in rules:
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {rule.verdict!r}")
        if not rule.path.startswith("/"):
            raise ValueError("the path of a rule starts with /")
        text = rule.host.translate(str.maketrans(UPPER, LOWER)) + rule.path
        chosen[text] = chosen.get(text, False) or rule.verdict == "block"
    if len(chosen) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    texts = sorted(chosen, key=lambda t: (xxhash.xxh64_intdigest(t), t))
    stored = [t.encode() for t in texts]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
    ends = np.cumsum([len(t) for t in stored], dtype=np.int64)
    flags = np.array([chosen[t] for t in texts], np.int64)
    strings = b"".join(stored)
    lengths = sorted({len(t) - t.index("/") for t in texts})
    head = np.array([len(texts), len(strings), len(lengths), *lengths], np.int64)
    return b"".join([head.tobytes(), keys.tobytes(), ends.tobytes(), flags.tobytes(), strings])


class DigestArray:
    """The mapped file."""

    def __init__(self, path: str):
        count, size, kinds = (int(x) for x in np.fromfile(path, np.int64, 3))
        self.path_lengths = np.fromfile(path, np.int64, kinds, offset=24).tolist()
        at = 24 + 8 * kinds
        view = lambda kind, k: np.memmap(path, kind, "r", at + 8 * k * count, (count,)) if count else np.zeros(0, kind)
        self.keys, self.ends, self.flags = view(np.uint64, 0), view(np.int64, 1), view(np.int64, 2)
        self.strings = np.memmap(path, np.uint8, "r", at + 24 * count, (size,)) if size else np.zeros(0, np.uint8)

    def text(self, k: int) -> str:
        start = self.ends[k - 1] if k else 0
        return bytes(self.strings[start : self.ends[k]]).decode()

    def find(self, probes: list[str]) -> np.ndarray:
        """Place of each probed string, -1 when it isn't stored."""
        digests = np.fromiter((xxhash.xxh64_intdigest(p) for p in probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, digests)
        out = np.full(len(probes), -1, np.int64)
        inside = np.flatnonzero(at < len(self.keys))
        for p in inside[np.asarray(self.keys[at[inside]]) == digests[inside]]:
            k = int(at[p])
            while k < len(self.keys) and self.keys[k] == digests[p]:
                if self.text(k) == probes[p]:
                    out[p] = k
                    break
                k += 1
        return out


def fitting_rules(hosts: list[str], paths: list[str], rules: DigestArray) -> list[tuple[str | None, str | None]]:
    """(rule, verdict) of the longest rule that fits each pair, or two nulls."""
    probes: list[str] = []
    owner: list[int] = []
    for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        at = 0
        while host:
            suffix = host[at:]
            for size in rules.path_lengths:
                if size > len(path):
                    break
                probes.append(suffix + path[:size])
                owner.append(row)
            dot = host.find(".", at)
            if dot < 0:
                break
            at = dot + 1
    out: list[tuple[str | None, str | None]] = [(None, None)] * len(hosts)
    found = rules.find(probes)
    for p in np.flatnonzero(found >= 0):
        row, text = owner[p], probes[p]
        if out[row][0] is None or len(text) > len(out[row][0]):
            out[row] = (text, "block" if rules.flags[found[p]] else "allow")
    return out


def judge_urls(pages: DataFrame, rules: Iterable[Rule], default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (``page_id``, ``url``).

    The verdict is the rule's, else ``default``. A null URL, an empty one and one without
    ``://`` have an empty host and path and get ``default``. Repeated rows are judged each;
    other columns of ``pages``, whatever their names, are left out; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark, "url-rules")
    name = f"{folder.rsplit('/', 1)[-1]}.bin"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(pack_rules(rules)))
    stream.close()
    spark.sparkContext.addFile(where.toString())

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            pairs = fitting_rules(batch.column(1).to_pylist(), batch.column(2).to_pylist(), array)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([r for r, _ in pairs], pa.string()),
                    pa.array([v or default for _, v in pairs], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    rest = F.coalesce(F.expr("CASE WHEN locate('://', url) > 0 THEN substring(url, locate('://', url) + 3) END"), F.lit(""))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), rest.alias("rest")).select(
        "page_id",
        F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    return parts.mapInArrow(judged, "page_id long, host string, path string, rule string, verdict string")
