"""CSV records that may cross lines, read from many places of a file at once.

A file is split where Spark splits text: a range is a part of a file, with the lines that begin
in it. Whether its first line begins a record or goes on inside a quoted field is not known when
the range is read on its own. So there are two passes, both in parallel:

1. Each range says how it would end, inside a quoted field or outside, from either start: two
   bits. Followed along a file, they tell how each range starts.
2. Each range cuts its lines into records. What it holds of a record that began in an earlier
   range, or goes on in a later one, is a fragment; fragments of a record are grouped together.

The driver sees a few numbers for each range and no line but a file's header.
"""

import re
from collections.abc import Iterator, Sequence
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.sources.shipping import ship

# A field that begins with a quote ends at the next quote that is not doubled. Whatever stands
# between that and the separator belongs to the field and opens nothing.
_CLOSED_FIELD = re.compile(rb'(^|,)"(?:[^"]|"")*+"')
_OPEN_FIELD = re.compile(rb'(?:^|,)"')
_REST_OF_FIELD = re.compile(rb'(?:[^"]|"")*+"')

BYTE_ORDER_MARK = "﻿".encode()


class Range(NamedTuple):
    """A part of a file: how it starts, where the record began that it starts inside of, and
    whether lines end in a carriage return as well."""

    starts_inside: bool
    began: int
    returns: bool


def ends_inside(line: bytes, starts_inside: bool) -> bool:
    """Whether a quoted field is open at the end of the line."""
    if starts_inside:
        rest = _REST_OF_FIELD.match(line)
        if not rest:
            return True
        line = b"x" + line[rest.end() :]
    return bool(_OPEN_FIELD.search(_CLOSED_FIELD.sub(rb"\1", line)))


def lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """value (bytes), file (a number for the path) and start (of the range) of every line."""
    text = spark.read.text(list(files), lineSep="\n")
    return text.select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The lines of a task, by range; a range may come in several pieces one after the other."""
    for batch in batches:
        files, starts = batch["file"].to_pylist(), batch["start"].to_pylist()
        begin = 0
        for key, rows in groupby(zip(files, starts, strict=True)):
            size = sum(1 for _ in rows)
            yield key, batch["value"].slice(begin, size)
            begin += size


class _Summary:
    """What the first pass finds out about one range."""

    def __init__(self, is_first: bool):
        self.from_outside, self.from_inside = False, True
        self.closes = False  # whether a record that is open at the start ends here
        self.is_first, self.header, self.returns = is_first, b"", False
        self.header_ended = not is_first

    def add(self, line: bytes, has_quote: bool) -> None:
        if not self.header_ended:
            if not self.header:
                self.returns = line.endswith(b"\r")
                self.header = line.removesuffix(b"\r")
            else:
                self.header += b"\n" + line.removesuffix(b"\r")
            self.header_ended = bool(self.header) and not ends_inside(line, self.from_outside)
        if has_quote:
            self.from_outside = ends_inside(line, self.from_outside)
            self.from_inside = ends_inside(line, self.from_inside)
        self.closes = self.closes or not self.from_inside


def _with_marks(values: pa.Array) -> Iterator[tuple[bytes, bool]]:
    """Every line, and whether there is a quote in it at all."""
    marks = pc.fill_null(pc.match_substring(values, b'"'), False).to_pylist()
    return zip((value.as_py() for value in values), marks, strict=True)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each range ends from either start, and the first record of each file."""
    found: dict[tuple[int, int], _Summary] = {}
    for key, values in _ranges(batches):
        is_new = key not in found
        summary = found.setdefault(key, _Summary(key[1] == 0))
        for line, has_quote in _with_marks(values):
            if is_new and summary.is_first:
                line, is_new = line.removeprefix(BYTE_ORDER_MARK), False
            summary.add(line, has_quote)
    if found:
        rows = [
            (*key, s.from_outside, s.from_inside, s.closes, s.returns, s.header_ended, s.header if s.is_first else None)
            for key, s in found.items()
        ]
        kinds = [pa.int64(), pa.int64(), *[pa.bool_()] * 5, pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            [field.split()[0] for field in _SCANNED.split(", ")],
        )


_SCANNED = (
    "file long, start long, from_outside boolean, from_inside boolean, closes boolean, "
    "returns boolean, header_ended boolean, header binary"
)


def scan(text: DataFrame) -> tuple[dict[tuple[int, int], Range], set[bytes]]:
    """How every range starts, by file and start, and the different headers of the files."""
    summary = sorted(text.mapInArrow(_scan, _SCANNED).collect(), key=lambda r: (r.file, r.start))
    ranges, headers = {}, set()
    for file, own in groupby(summary, key=lambda r: r.file):
        inside, began, returns = False, 0, False
        for row in own:
            if row.start == 0:
                returns = row.returns
                headers.add(bytes(row.header))
                if not row.header_ended:
                    raise ValueError("a file's header is not closed in the part of the file it begins in")
            ranges[file, row.start] = Range(inside, began, returns)
            if not inside or row.closes:  # what is open at the end began in this range
                began = row.start
            inside = row.from_inside if inside else row.from_outside
    return ranges, headers


def _cut(ranges: dict[tuple[int, int], Range]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[bytes] = []  # lines of the record that is open
        out: list[tuple] = []
        current, how = None, Range(False, 0, False)
        inside = is_head = header_due = mark_due = False

        def fragment() -> None:
            if pending:
                began = how.began if is_head else current[1]
                out.append((b"\n".join(pending), current[0], began, current[1]))
                pending.clear()

        def batch_of() -> pa.RecordBatch:
            texts, *numbers = zip(*out, strict=True)
            decoded = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
            out.clear()
            arrays = [decoded, *(pa.array(n, pa.int64()) for n in numbers)]
            return pa.RecordBatch.from_arrays(arrays, ["record", "file", "began", "start"])

        for key, values in _ranges(batches):
            if key != current:
                fragment()
                if key not in ranges:
                    raise RuntimeError("the files, or how they are split, changed between two passes")
                current, how = key, ranges[key]
                inside = is_head = how.starts_inside
                header_due = mark_due = key[1] == 0
            for line, has_quote in _with_marks(values):
                if mark_due:
                    line, mark_due = line.removeprefix(BYTE_ORDER_MARK), False
                if has_quote:
                    inside = ends_inside(line, inside)
                pending.append(line.removesuffix(b"\r") if how.returns else line)
                if inside:
                    continue
                if is_head:
                    fragment()
                    is_head = False
                    continue
                record = b"\n".join(pending)
                pending.clear()
                if record and header_due:
                    header_due = False
                elif record:
                    out.append((record, current[0], None, current[1]))
            if out:
                yield batch_of()
        fragment()
        if out:
            yield batch_of()

    return cut


def records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """One row for each record of the files but their headers: ``record``, as it is written.

    Lines end in a line feed; in a file whose first line has a carriage return before it, that
    is taken off every line, also inside a record. Empty lines between records are left out. A
    quote that is never closed makes one record of all that follows it in its file. The files
    must share a header.
    """
    ship(spark)
    text = lines(spark, files)
    ranges, headers = scan(text)
    if len(headers) > 1:
        raise ValueError("the files differ in their header")
    pieces = text.mapInArrow(_cut(ranges), "record string, file long, began long, start long")
    whole = pieces.where("began IS NULL").select("record")
    parts = F.sort_array(F.collect_list(F.struct("start", "record")))
    joined = F.array_join(F.transform(parts, lambda p: p["record"]), "\n")
    crossing = pieces.where("began IS NOT NULL").groupBy("file", "began").agg(joined.alias("record"))
    return whole.union(crossing.select("record"))
