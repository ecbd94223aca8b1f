"""Word counts and word-sequence hashes of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .text import Powers, byte_blocks, byte_table, sequence_hashes, word_hashes, word_spans


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: a new start for its lineage."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def with_lengths(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_words, seq_a, seq_b, text_hash`` of every row; the sequence hashes are those of
    the words with A-Z lower-cased. A null text has no words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables = byte_table(lower=True), Powers()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], []]
            for _, offsets, data in byte_blocks(batch.column(2)):
                rows = len(offsets) - 1
                starts, ends, owner = word_spans(data, offsets)
                hashes = word_hashes(data, starts, ends, table, tables)
                one, two = sequence_hashes(hashes, owner, rows)
                for part, values in zip(parts, (np.bincount(owner, minlength=rows), one.view(np.int64), two.view(np.int64)), strict=True):
                    part.append(values.astype(np.int64))
            columns = [pa.array(np.concatenate(p) if p else np.zeros(0, np.int64)) for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, batch.column(3)], names=["doc_id", "source", "n_words", "seq_a", "seq_b", "text_hash"])

    text = F.col("text").cast("string")
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    )
    return chosen.mapInArrow(counted, "doc_id long, source string, n_words long, seq_a long, seq_b long, text_hash long")
