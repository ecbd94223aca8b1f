"""JSON documents read piecewise: one row for each element of a document's array.

A document is ``{…, "features": […], …}`` (or another member that holds the array) or the array itself. A
task reads a file in chunks and gives each element, as the text it has there, as soon as it is whole. So
memory is bounded by an element and a chunk, not by the document; a member that isn't the array is the
one thing read whole besides. One file is one task, as nothing tells where an element begins.

The classes go to the tasks by value; they need pyarrow, but not this package.
"""

from __future__ import annotations

import codecs
import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .listing import opened

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "path string, place bigint, head string, value string"
CHUNK = 1 << 20
BLANK = " \t\n\r﻿"


class Text:
    """A sliding window over the text of a file, and JSON values decoded from its front."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.decoder = chunks, json.JSONDecoder()
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.held, self.at, self.over = "", 0, False

    def more(self) -> bool:
        """Read on; False at the end of the file."""
        chunk = None if self.over else next(self.chunks, None)
        if chunk is None:
            self.over = True
            return False
        self.held, self.at = self.held[self.at :] + self.utf8.decode(chunk), 0
        return True

    def sign(self) -> str:
        """The next character that isn't blank, left where it is; empty at the end."""
        while True:
            while self.at < len(self.held) and self.held[self.at] in BLANK:
                self.at += 1
            if self.at < len(self.held) or not self.more():
                return self.held[self.at : self.at + 1]

    def take(self, sign: str) -> None:
        if self.sign() != sign:
            raise ValueError(f"{sign!r} is missing")
        self.at += 1

    def value(self) -> str:
        """The text of the next value, whole. A number counts as whole once something follows it."""
        self.sign()
        while True:
            try:
                _, end = self.decoder.raw_decode(self.held, self.at)
                if end < len(self.held) or self.over:
                    text, self.at = self.held[self.at : end], end
                    return text
            except json.JSONDecodeError:
                if self.over:
                    raise ValueError("a value is cut off or isn't JSON") from None
            # twice as much each time, so that a long value isn't decoded again and again
            wanted = 2 * (len(self.held) - self.at)
            while self.more() and len(self.held) < wanted:
                pass


def elements(chunks: Iterator[bytes], member: str | None) -> Iterator[str]:
    """The text of each element of the array that a document is, or holds as ``member``. A blank
    document, one without the member, and one whose member is no array give nothing."""
    text = Text(chunks)
    if not text.sign():
        return
    if member is not None:
        if text.sign() != "{":
            return
        text.take("{")
        while text.sign() != "}":
            name = json.loads(text.value())
            text.take(":")
            if name == member:
                break
            text.value()
            if text.sign() == ",":
                text.take(",")
        else:
            return
    if text.sign() != "[":
        return
    text.take("[")
    while text.sign() != "]":
        yield text.value()
        if text.sign() == ",":
            text.take(",")
        elif text.sign() != "]":
            raise ValueError("',' or ']' is missing")


class Page(InputPartition):
    pass


class Pages(DataSourceReader):
    def __init__(self, path: str, member: str | None, chunk: int):
        self.path, self.member, self.chunk = path, member, chunk

    def partitions(self) -> list[Page]:
        from pyarrow import fs

        system, place = opened(self.path)
        found = system.get_file_info(place)
        inside = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))
        files = (i for i in inside if i.type == fs.FileType.File and not i.base_name.startswith(("_", ".")))
        return [Page(i.path) for i in sorted(files, key=lambda i: -i.size)] or [Page(None)]

    def read(self, partition: Page) -> Iterator[tuple]:
        if partition.value is None:
            return
        system, _ = opened(self.path)
        with system.open_input_stream(partition.value) as stream:
            head = None
            try:
                for place, value in enumerate(elements(iter(lambda: stream.read(self.chunk), b""), self.member)):
                    if self.member is None and place == 0:
                        head = value
                    yield partition.value, place, head, value
            except ValueError as error:
                raise ValueError(f"{partition.value}: {error}") from None


class PageSource(DataSource):
    """``spark.read.format("json_pages").option("member", "features").load(path)``: ``path, place, head, value``.

    Without ``member`` the documents are arrays, and ``head`` is the first element of each."""

    @classmethod
    def name(cls) -> str:
        return "json_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Pages(self.options["path"], self.options.get("member"), int(self.options.get("chunk", CHUNK)))


def page_elements(spark: SparkSession, path: str, member: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The elements of all documents below a folder, a row each."""
    spark.dataSource.register(PageSource)
    reader = spark.read.format("json_pages").option("chunk", chunk)
    return (reader if member is None else reader.option("member", member)).load(path)
