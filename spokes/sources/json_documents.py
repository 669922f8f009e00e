"""JSON documents that are one long array, read by many tasks and written by many.

Spark's own JSON reader takes such a document as one row.  Here a file is read
in its byte splits, in fragments that end with a closing bracket, and tasks find
the elements by the depth of brackets.  Where a split begins, the depth, and
whether a string is open, follow from all splits before it; so a first pass sums
up each split for both cases, the driver chains the splits of each file (a few
numbers a split), and a second pass cuts out the elements.  An element over
several splits is put together from its pieces.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import _path
from ..session import work_dir, written

# executors need pyarrow, not an installed copy of this package
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
LAST = (1 << 31) - 1  # the index of an element that goes on in the next split


def _fragments(spark: SparkSession, path: str, end: str) -> DataFrame:
    rows = spark.read.option("lineSep", end).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _blocks(batches: Iterator[pa.RecordBatch], end: str) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, block, fragment) in order; fragments have their end again."""
    for b in batches:
        for file, block, value in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("value").to_pylist()):
            yield file, block, value + end


def _summaries(rows: DataFrame, end: str) -> DataFrame:
    """For each split, begun outside a string (0) or in one (1): whether it ends in one, net depth, lowest depth.

    ``nested``: the first two brackets open, as far as a split outside a string tells.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out = None, []
        for file, block, text in _blocks(batches, end):
            if (file, block) != at:
                at, odd, net, low, first = (file, block), 0, [0, 0], [0, 0], []
                out.append([file, block, 0, 0, 0, 1, 0, 0, None])
            for t in TOKEN.finditer(text):
                c = t[0]
                if c == '"':
                    odd ^= 1
                elif c in "{[":
                    net[odd] += 1
                    if not odd and len(first) < 2:
                        first.append(True)
                elif c in "}]":
                    net[odd] -= 1
                    low[odd] = min(low[odd], net[odd])
                    if not odd and len(first) < 2:
                        first.append(False)
            out[-1][2:] = [odd, net[0], low[0], 1 - odd, net[1], low[1], first == [True, True]]
        kinds = [pa.string(), *[pa.int64()] * 7, pa.bool_()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    names = ["file", "block", "end0", "net0", "low0", "end1", "net1", "low1", "nested"]
    return rows.mapInArrow(run, "file string, block long, end0 long, net0 long, low0 long, end1 long, net1 long, low1 long, nested boolean")


def _chain(summaries: list, depth: int | None) -> dict[tuple[str, int], tuple[bool, int, int | None, int]]:
    """(in a string, depth, split that the open element began in, depth of elements) at the start of each split."""
    out, file = {}, None
    for s in sorted(summaries, key=lambda r: (r.file, r.block)):
        if s.file != file:
            file, quoted, at, owner = s.file, False, 0, None
            of = depth or (2 if s.nested else 1)
        out[s.file, s.block] = (quoted, at, owner, of)
        ends, net, low = (s.end1, s.net1, s.low1) if quoted else (s.end0, s.net0, s.low0)
        if at + net < of:
            owner = None
        elif at < of or at + low < of:
            owner = s.block
        quoted, at = bool(ends), at + net
    return out


def elements(spark: SparkSession, path: str, depth: int | None = None, end: str = "}") -> DataFrame:
    """``file, block, index, text``: the JSON text of every element at ``depth`` of the files at ``path``.

    An element is what the ``depth``-th open bracket encloses; without a depth,
    what the second one does in a file that begins with two (an array of
    arrays), else the first (lines of arrays).  ``end`` is the bracket that
    closes the elements.  (block, index) order a file's elements.
    """
    rows = _fragments(spark, path, end)
    summaries = _summaries(rows, end).collect()  # one row for each split
    start = spark.sparkContext.broadcast(_chain(summaries, depth))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def close() -> None:  # what is left open at a split's end
            if held is not None:
                out.append((at[0], owner, LAST, at[1], "".join(held)))

        at, held, owner = None, None, None
        for file, block, text in _blocks(batches, end):
            if (file, block) != at:
                if at:
                    close()
                at, index = (file, block), 0
                quoted, level, owner, of = start.value[at]
                held = [] if owner is not None else None
                whole = False
            begin = 0
            for t in TOKEN.finditer(text):
                c = t[0]
                if c == '"':
                    quoted = not quoted
                elif quoted or c[0] == "\\":
                    continue
                elif c in "{[":
                    level += 1
                    if level == of:
                        begin, held, owner, whole = t.start(), [], block, True
                else:
                    level -= 1
                    if level == of - 1 and held is not None:
                        held.append(text[begin:t.end()])
                        out.append((file, owner, index if whole else LAST, block, "".join(held)))
                        index, held, owner = index + whole, None, None
            if held is not None:
                held.append(text[begin:])
            if len(out) >= 5000:
                yield batch(out)
                out.clear()
        if at:
            close()
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["file", "block", "index", "piece", "text"])

    found = written(rows.mapInArrow(run, "file string, block long, index long, piece long, text string"), "json-elements")
    cut = found.where(F.col("index") == LAST).groupBy("file", "block", "index").agg(
        F.sort_array(F.collect_list(F.struct("piece", "text"))).alias("p"))  # the pieces of one element
    cut = cut.select("file", "block", "index", F.array_join("p.text", "").alias("text"))
    return found.where(F.col("index") < LAST).select("file", "block", "index", "text").union(cut)


def write_document(rows: DataFrame, path: str, head: str, foot: str, line: str = "\n") -> None:
    """One document at ``path``: ``head``, the rows' ``value`` in order, commas between them and ``line`` after each, ``foot``.

    All tasks write their rows; to commit, the parts are streamed one after the
    other into a hidden file, which then gets its name.
    """
    spark = rows.sparkSession
    stage = work_dir(spark, "document")
    rows.select(F.concat(F.lit(","), F.col("value")).alias("value")).write.option("lineSep", line).text(stage)
    fs, target = _path(spark, path)
    folder, _, name = path.rpartition("/")
    _, hidden = _path(spark, f"{folder}/.{name}.tmp")
    source, at = _path(spark, stage)
    copy = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    out, first = fs.create(hidden, True), True
    try:
        out.write(bytearray(head.encode()))
        parts = sorted((s.getPath() for s in source.listStatus(at)), key=lambda p: p.getName())
        for part in parts:
            if part.getName().startswith("part-") and source.getFileStatus(part).getLen():
                src = source.open(part)
                try:
                    if first:
                        src.skip(1)  # nothing comes before the first row
                    copy(src, out, 1 << 16, False)
                finally:
                    src.close()
                first = False
        out.write(bytearray(foot.encode()))
    finally:
        out.close()
    fs.delete(target, True)
    if not fs.rename(hidden, target):
        raise OSError(f"{path} could not be committed")
    source.delete(at, True)
