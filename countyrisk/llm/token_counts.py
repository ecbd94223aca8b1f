"""Token counts through a cache of digests.

Every text is brought to its normal form (null as empty, bytes that aren't UTF-8 replaced) and
named by the SHA-256 of it. Counts are stored under that digest and the version of the tokenizer,
a digest of its file, its library and the library's version. A run joins its digests to the
stored counts, encodes each text that is missing once, and appends the new counts to the cache.

The cache is a Parquet table, one folder a version. Its rows hold on their own, so a run that
dies while it appends, or two that append the same digest, do no harm: the next run reads what is
there, and of equal rows one counts. Texts move once at most, one for each digest and task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from importlib.metadata import version as installed
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .lengths import written
from .text import BLOCK

LIMIT = 1_024
KNOWN = 200_000
SHORT = 64
CACHE = "digest binary, n_tokens long, version string"

# Unicode's White_Space characters.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Tokenizer:
    """A tokenizer file's bytes, its library and the digest that names both."""

    def __init__(self, file: str):
        self.blob = Path(file).read_bytes()
        self.library = "sentencepiece" if file.endswith(".model") else "tokenizers"
        name = f"{self.library} {installed(self.library)} without special tokens\n"
        self.version = hashlib.sha256(name.encode() + self.blob).hexdigest()


def cuts_at_spaces(spec: dict) -> bool:
    """Whether a text's tokens are those of its pieces, cut in front of white space.

    So for byte-level splitting: white space begins a new part unless white space is before it."""
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    white = re.compile(f"[{WHITE}]")
    apart = all(
        not (t["lstrip"] or t["rstrip"] or t["single_word"] or white.search(t["content"])) for t in spec.get("added_tokens") or []
    )
    return plain and apart and not spec.get("normalizer") and not spec.get("post_processor")


def counter(library: str, blob: bytes) -> Callable[[list[str]], list[int]]:
    """The function that counts the tokens of texts."""
    if library == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    import tokenizers

    model = tokenizers.Tokenizer.from_buffer(blob)
    model.no_truncation()
    model.no_padding()

    def encoded(texts: list[str]) -> list[int]:
        return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    if not cuts_at_spaces(json.loads(blob)):
        return encoded
    pieces = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
    known: dict[str, int] = {}

    def by_piece(texts: list[str]) -> list[int]:
        cut = [pieces(text) for text in texts]
        here = set().union(*cut)
        missing = [piece for piece in here if piece not in known]
        counts = dict(zip(missing, encoded(missing), strict=True))
        counts |= {piece: known[piece] for piece in here if piece in known}
        if len(known) > KNOWN:
            known.clear()
        known.update((piece, counts[piece]) for piece in missing if len(piece) <= SHORT)
        return [sum(map(counts.__getitem__, own)) for own in cut]

    return by_piece


def encoder(tokenizer: Tokenizer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``digest, content`` to ``digest, n_tokens, version``, about 1 MB of text at a time."""
    library, blob, version = tokenizer.library, tokenizer.blob, tokenizer.version

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = counter(library, blob)
        for batch in batches:
            content = batch.column(1)
            ends = np.cumsum(pc.binary_length(content).to_numpy(zero_copy_only=False).astype(np.int64))
            counts: list[int] = []
            while len(counts) < len(ends):
                at = len(counts)
                end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
                counts += count(content.slice(at, end - at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array([version] * len(counts), pa.string())],
                names=["digest", "n_tokens", "version"],
            )

    return encoded


def stored_counts(docs: DataFrame, cache_dir: str, version: str) -> DataFrame:
    """``digest, n_tokens`` that the cache holds for a version; the folder is made if there is none."""
    spark = docs.sparkSession
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("version").parquet(cache_dir)
    return spark.read.schema(CACHE).parquet(cache_dir).where(F.col("version") == version).select("digest", "n_tokens")


def count_tokens(docs: DataFrame, tokenizer_file: str, cache_dir: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs`` (``doc_id``, ``text``).

    ``tokenizer_file`` is read by the driver and sent to the tasks, ``cache_dir`` is a folder that all
    executors reach (a new scratch folder, if none is given). Tokens are those that the library
    gives without begin, end or other added tokens. A null text is empty: no bytes, no tokens.
    Bytes that aren't UTF-8 count in ``n_bytes`` and are encoded as replacement characters. Rows without an id,
    repeated rows and ids give a row each; other columns are left out; an empty table gives no rows."""
    spark = docs.sparkSession
    tokenizer = Tokenizer(tokenizer_file)
    cache_dir = cache_dir or scratch_dir(spark, "token-cache")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    content = F.make_valid_utf8(text)
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest"))
    keyed = written(keyed, "token-digests")
    stored = stored_counts(docs, cache_dir, tokenizer.version)
    if not keyed.select("digest").join(stored, "digest", "left_anti").isEmpty():
        # one text for each digest and task is moved, so a text that a third of all rows have is no hot key
        texts = docs.select(digest.alias("digest"), content.alias("content"))
        texts = texts.withColumn("row", F.row_number().over(Window.partitionBy("digest").orderBy("digest"))).where("row = 1")
        misses = texts.select("digest", "content").join(stored, "digest", "left_anti")
        misses.mapInArrow(encoder(tokenizer), CACHE).write.mode("append").partitionBy("version").parquet(cache_dir)
        stored = stored_counts(docs, cache_dir, tokenizer.version)
    counts = stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
