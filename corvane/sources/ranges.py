"""Lines of a text collection fetched by their byte offsets, without reading the rest.

A docno of :func:`corvane.sources.text.read_lines` is the offset of a line in the
collection's files, taken in path order. Asked docnos are sorted and dealt over tasks by
range, so a task opens few files and reads forward from offset to offset.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.sources.text import read_lines

# Bytes of the first read at an offset; a longer line is read in pieces twice as long each.
FIRST_READ = 4096


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:/", "file:///", 1))


def _starts(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[int]]:
    """The collection's files in order and the docno of each one's first line.

    One light row for each file. A file that doesn't end a line takes one byte more.
    """
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = []
            for file, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                last = b"\n"
                if size:
                    system, place = _opened(file)
                    with system.open_input_file(place) as handle:
                        handle.seek(size - 1)
                        last = handle.read(1)
                taken.append(size + (last != b"\n"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(taken, pa.int64())], names=["file", "bytes"])

    rows = files.mapInArrow(ends, "file string, bytes long").orderBy("file").collect()
    names, starts, at = [], [], 0
    for file, taken in rows:
        names.append(file)
        starts.append(at)
        at += taken
    return names, starts


def _line_at(handle, offset: int, count: Callable[[int], None]) -> bytes:
    """The line that begins at ``offset``; it ends at LF, CR LF, CR or the end of the file."""
    handle.seek(offset)
    held, size = b"", FIRST_READ
    while True:
        piece = handle.read(size)
        count(len(piece))
        found = held + piece
        ends = [at for at in (found.find(b"\n", len(held)), found.find(b"\r", len(held))) if at >= 0]
        if ends:
            return found[:min(ends)]
        if len(piece) < size:
            return found
        held, size = found, 2 * size


def line_reader(spark: SparkSession, path: str | list[str], bytes_read=None) -> Callable[[DataFrame], DataFrame]:
    """A function from (docno) rows, each docno once, to their (docno, text) lines.

    The files are plain text in a file system Arrow can open; where it can't, the lines are
    joined to the whole collection. A docno at which no file lies has no row. ``bytes_read``
    is an accumulator of the bytes that tasks read.
    """
    try:
        names, starts = _starts_if_open(spark, path)
    except _NotOpened:
        return lambda docnos: read_lines(spark, path).join(docnos.select("docno").distinct(), "docno", "left_semi")

    def count(n: int) -> None:
        if bytes_read is not None:
            bytes_read.add(n)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_file, handle = None, None
        for batch in batches:
            docnos, lines = [], []
            for docno in batch.column(0).to_pylist():
                at = bisect_right(starts, docno) - 1
                if at < 0:
                    continue
                if at != open_file:
                    system, place = _opened(names[at])
                    open_file, handle = at, system.open_input_file(place)
                if docno - starts[at] < handle.size():
                    docnos.append(docno)
                    lines.append(_line_at(handle, docno - starts[at], count))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docnos, pa.int64()), pa.array(lines, pa.binary()).view(pa.string())], names=["docno", "text"])

    def fetch(docnos: DataFrame) -> DataFrame:
        asked = docnos.select("docno").where("docno IS NOT NULL")
        return (asked.repartitionByRange("docno").sortWithinPartitions("docno")
                .mapInArrow(read, "docno long, text string"))

    return fetch


class _NotOpened(Exception):
    """Arrow knows no file system for the path."""


def _starts_if_open(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[int]]:
    first = (spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
             .limit(1).collect())
    if first:
        try:
            _opened(first[0].file)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as cause:
            raise _NotOpened(path) from cause
    return _starts(spark, path)
