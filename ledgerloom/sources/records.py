"""CSV records with a stable position, however a file is cut into byte ranges.

A quote opens a cell only where a cell begins, a doubled quote inside is one quote, and commas and line feeds inside belong to the cell. Whether a
line feed ends a record thus depends on all bytes before it. Every range first gives its transition: the state behind it for every state
before it. The transitions of a file, composed in order, say in what state each range begins; then the ranges are read independently. A
file of one range needs no first pass. The position of a record is its byte offset. Neighbouring small ranges share a task, and a range is read to
the end of its last record, so the work follows the bytes, not the number of ranges.

Inside a range the state matters only at quotes. Between two quotes a map of three states says what happens, depending on whether something stands between
them and whether a separator ends it; the maps are composed with a table, in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerloom import session
from ledgerloom.sources import decode, files

CHUNK_BYTES = 8 << 20
AHEAD_BYTES = 4 << 10  # read behind a range for the end of its last record
_FEED, _QUOTE, _COMMA, _RETURN = 10, 34, 44, 13

# state before a byte: where a cell begins, inside a plain cell, inside quotes, behind a quote that may close, where a record begins
CELL, PLAIN, QUOTED, CLOSED, RECORD = range(5)

# Maps of the states behind a quote (PLAIN, QUOTED, CLOSED) as numbers to the base of three. Between two quotes stand nothing, text that ends with a
# separator, or other text.
_MAPS = [(a, b, c) for c in range(3) for b in range(3) for a in range(3)]
_CODE = {m: i for i, m in enumerate(_MAPS)}
_COMPOSED = np.array([[_CODE[tuple(later[x] for x in first)] for later in _MAPS] for first in _MAPS], np.uint8)
_APPLIED = np.array(_MAPS, np.uint8) + 1
_NOTHING, _SEPARATED, _TEXT = _CODE[(0, 2, 1)], _CODE[(1, 2, 1)], _CODE[(0, 2, 0)]
_SAME = _CODE[(0, 1, 2)]


def _prefixes(maps: np.ndarray, row: int = 64) -> np.ndarray:
    """The composition of all maps up to each one."""
    n = len(maps)
    if n <= 1:
        return maps
    grid = np.full(-(-n // row) * row, _SAME, np.uint8)
    grid[:n] = maps
    grid = grid.reshape(-1, row)
    for i in range(1, row):
        grid[:, i] = _COMPOSED[grid[:, i - 1], grid[:, i]]
    if len(grid) > 1:
        before = _prefixes(grid[:-1, -1].copy(), row)
        grid[1:] = _COMPOSED[before[:, None], grid[1:]]
    return grid.ravel()[:n]


class Quotes:
    """The quotes of a piece of a file and what they do, for any state before the piece."""

    def __init__(self, data: bytes):
        self.bytes = np.frombuffer(data, np.uint8)
        self.at = np.flatnonzero(self.bytes == _QUOTE)
        behind = self.at[1:] - 1
        ends = self.bytes[behind]
        between = np.where(behind == self.at[:-1], _NOTHING, np.where((ends == _COMMA) | (ends == _FEED), _SEPARATED, _TEXT))
        self.maps = _prefixes(between.astype(np.uint8))

    def _first(self, state: int) -> int:
        """The state behind the first quote."""
        at = int(self.at[0])
        if state == QUOTED:
            return CLOSED
        if at == 0:
            return PLAIN if state == PLAIN else QUOTED
        return QUOTED if self.bytes[at - 1] in (_COMMA, _FEED) else PLAIN

    def states(self, state: int) -> np.ndarray:
        """The state behind each quote."""
        if not len(self.at):
            return np.empty(0, np.uint8)
        first = self._first(state)
        return np.append(np.uint8(first), _APPLIED[self.maps, first - 1])

    def after(self, state: int) -> int:
        """The state behind the piece."""
        if not len(self.bytes):
            return state
        if len(self.at):
            first = self._first(state)
            state = int(_APPLIED[self.maps[-1], first - 1]) if len(self.maps) else first
            if self.at[-1] == len(self.bytes) - 1:
                return state
        if state == QUOTED:
            return QUOTED
        return {_COMMA: CELL, _FEED: RECORD}.get(int(self.bytes[-1]), PLAIN)

    def transition(self) -> list[int]:
        return [self.after(s) for s in range(5)]

    def separators(self, state: int) -> np.ndarray:
        """Places of the commas and line feeds that end a cell."""
        found = np.flatnonzero((self.bytes == _COMMA) | (self.bytes == _FEED))
        if not len(self.at):
            return found[:0] if state == QUOTED else found
        inside = np.append(state == QUOTED, self.states(state) == QUOTED)
        return found[~inside[np.searchsorted(self.at, found)]]

    def record_ends(self, state: int) -> np.ndarray:
        found = self.separators(state)
        return found[self.bytes[found] == _FEED]


_PARTS = re.compile(r'(?s)"((?:[^"]|"")*)"?(.*)')


def unquoted(cell: str) -> str:
    """A cell that begins with a quote: what the quotes hold, and whatever follows them as it is."""
    held, rest = _PARTS.fullmatch(cell).groups()
    return held.replace('""', '"') + rest


def records(data: bytes, encoding: str) -> tuple[np.ndarray, pa.ListArray]:
    """(offsets, cells) of the whole records that data holds; lines of blanks alone are none."""
    if not data:
        return np.empty(0, np.int64), pa.array([], pa.list_(pa.string()))
    quotes = Quotes(data)
    raw = quotes.bytes
    ends = quotes.separators(RECORD)
    starts = np.append(0, ends[:-1] + 1)
    cells = decode.texts(data, np.append(0, ends + 1), encoding)
    last = raw[ends] == _FEED
    returned = last & (ends > starts) & (raw[np.maximum(ends - 1, 0)] == _RETURN)
    cells = pc.if_else(pa.array(returned), pc.utf8_slice_codeunits(cells, 0, -2), pc.utf8_slice_codeunits(cells, 0, -1))
    bounds = np.append(0, np.flatnonzero(last) + 1)
    offsets = starts[bounds[:-1]]
    alone = np.flatnonzero(np.diff(bounds) == 1)
    blank = np.zeros(len(offsets), bool)
    blank[alone] = pc.equal(pc.utf8_trim(cells.take(pa.array(bounds[alone])), " \t"), "").to_numpy(zero_copy_only=False)
    opened = np.flatnonzero((ends > starts) & (raw[starts] == _QUOTE))
    if len(opened):
        many = np.searchsorted(quotes.at, ends[opened]) - np.searchsorted(quotes.at, starts[opened])
        stop = ends[opened] - 1 - returned[opened]
        plain = (many == 2) & (raw[stop] == _QUOTE)
        inner = cells.take(pa.array(opened))
        held = pc.utf8_slice_codeunits(inner, 1, -1)
        if not plain.all():
            held = pc.replace_with_mask(held, pa.array(~plain), pa.array([unquoted(c) for c in inner.filter(pa.array(~plain)).to_pylist()], pa.string()))
        mask = np.zeros(len(ends), bool)
        mask[opened] = True
        cells = pc.replace_with_mask(cells, pa.array(mask), held)
    rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), cells)
    return offsets[~blank], rows.filter(pa.array(~blank))


def head_end(read, skip: int) -> int:
    """Offset behind the first `skip` records; read(start, length) gives bytes. The whole length where there are fewer."""
    at, left, state = 0, skip, RECORD
    while left:
        data = read(at, 1 << 16)
        if not data:
            break
        quotes = Quotes(data)
        ends = quotes.record_ends(state)
        if len(ends) >= left:
            return at + int(ends[left - 1]) + 1
        left -= len(ends)
        state = quotes.after(state)
        at += len(data)
    return at


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["path"]
        self.skip = int(options.get("skip", 0))
        self.encoding = options.get("encoding", "utf-8")
        self.split_bytes = int(options.get("split_bytes", files.SPLIT_BYTES))
        self.states = options.get("states", "")
        self.tasks = int(options.get("tasks", 0))

    def partitions(self):
        ranges = files.byte_ranges(self.paths, (), self.split_bytes)
        if self.states and len(self.states) != len(ranges):
            raise ValueError("files have changed since their quotes were read")
        stated = [_StatedRange(**vars(r), state=int(s)) for r, s in zip(ranges, self.states or str(RECORD) * len(ranges), strict=True)]
        self.states = ""  # the workers need it no more
        some = -(-len(stated) // (self.tasks or len(stated)))
        return [_Ranges(stated[i : i + some]) for i in range(0, len(stated), some)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        for path, ranges in groupby(partition.ranges, lambda r: r.path):
            if path:
                yield from self._of_file(path, list(ranges))

    def _of_file(self, path: str, ranges: list) -> Iterator[pa.RecordBatch]:
        """Records of some ranges of a file, in order."""
        system, inner = files.file_system(path)
        held, held_at = b"", 0
        with system.open_input_file(inner) as handle:

            def read(start: int, length: int) -> bytes:
                handle.seek(start)
                return handle.read(length)

            def piece(start: int, length: int) -> bytes:
                nonlocal held, held_at
                if not held_at <= start <= start + length <= held_at + len(held):
                    wanted = min(ranges[-1].end + AHEAD_BYTES, start + CHUNK_BYTES) - start
                    held, held_at = read(start, max(length, wanted)), start
                return held[start - held_at : start - held_at + length]

            body = head_end(read, self.skip) if self.skip else 0
            for r in ranges:
                yield from self._of_range(piece, body, r)

    def _of_range(self, piece, body: int, partition) -> Iterator[pa.RecordBatch]:
        """Records that begin in [start, end), behind the head; the last one is read past the end of the range."""
        at, state = partition.start, partition.state
        if at < body:
            at, state = body, RECORD
        while state != RECORD and at < partition.end:
            quotes = Quotes(piece(at, min(CHUNK_BYTES, partition.end - at)))
            ends = quotes.record_ends(state)
            if len(ends):
                at, state = at + int(ends[0]) + 1, RECORD
            else:
                at, state = at + len(quotes.bytes), quotes.after(state)
                if not len(quotes.bytes):
                    return
        longer = 0
        while at < partition.end:
            block = piece(at, max(min(CHUNK_BYTES, partition.end - at + AHEAD_BYTES), longer))
            if not block:
                return
            quotes = Quotes(block)
            ends = quotes.record_ends(RECORD)
            if at + len(block) >= partition.size:
                if quotes.after(RECORD) == QUOTED:
                    raise ValueError(f"{partition.path}: a quote is never closed")
                if not len(ends) or ends[-1] != len(block) - 1:
                    block, ends = block + b"\n", np.append(ends, len(block))
            if not len(ends):
                longer = 2 * len(block)  # a record longer than the piece
                continue
            # to the end of the record that holds the last byte of the range, if it is there
            cut = int(ends[min(np.searchsorted(ends, partition.end - at - 1), len(ends) - 1)]) + 1
            yield from self._rows(block[:cut], at, partition)
            at, longer = at + cut, 0

    def _rows(self, block: bytes, offset: int, partition) -> Iterator[pa.RecordBatch]:
        at, cells = records(block, self.encoding)
        ours = int(np.searchsorted(at + offset, partition.end))
        if not ours:
            return
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([files.base_name(partition.path)] * ours, pa.string()),
                pa.array(np.full(ours, partition.file_no, dtype=np.int32)),
                pa.array((at[:ours] + offset).astype(np.int64)),
                cells.slice(0, ours),
            ],
            names=["source_file", "file_no", "line_no", "cells"],
        )


@dataclass
class _StatedRange(files.FileRange):
    state: int


@dataclass
class _Ranges(InputPartition):
    """The ranges that a task reads, one after another."""

    ranges: list[_StatedRange]


class RecordDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "positioned_records"

    def schema(self) -> str:
        return "source_file string, file_no int, line_no bigint, cells array<string>"

    def reader(self, schema) -> RecordReader:
        return RecordReader(dict(self.options))


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The transitions of neighbouring ranges of a file, five digits each."""
    for batch in batches:
        for row in batch.to_pylist():
            system, inner = files.file_system(row["path"])
            found = []
            with system.open_input_file(inner) as handle:
                handle.seek(row["start"])
                for start in range(row["start"], row["end"], row["split"]):
                    states = list(range(5))
                    left = min(row["split"], row["end"] - start)
                    while left > 0 and (data := handle.read(min(left, CHUNK_BYTES))):
                        step = Quotes(data).transition()
                        states = [step[s] for s in states]
                        left -= len(data)
                    found.append("".join(map(str, states)))
            yield pa.RecordBatch.from_pydict({"number": pa.array([row["number"]], pa.int64()), "states": ["".join(found)]})


def task_count(spark: SparkSession, ranges: list) -> int:
    """Tasks that read the ranges: one for each SPLIT_BYTES, two for each shuffle partition at least where there are as many ranges."""
    return max(1, min(len(ranges), max(2 * session.shuffle_width(spark), -(-sum(r.end - r.start for r in ranges) // files.SPLIT_BYTES))))


def range_states(spark: SparkSession, ranges: list, split_bytes: int) -> str:
    """The state before each byte range, a digit each; tasks read the transitions, five digits of each range come back."""
    later = [(i, r) for i, r in enumerate(ranges) if r.end < r.size or r.start]
    if not later:
        return str(RECORD) * len(ranges)
    tasks = task_count(spark, [r for _, r in later])
    some = -(-len(later) // tasks)
    runs = []
    for at in range(0, len(later), some):
        for path, run in groupby(later[at : at + some], lambda x: x[1].path):
            run = list(run)
            runs.append((run[0][0], path, run[0][1].start, run[-1][1].end, split_bytes))
    todo = spark.createDataFrame(runs, "number long, path string, start long, end long, split long").repartition(tasks)
    found = {
        r["number"] + i: r["states"][5 * i : 5 * i + 5]
        for r in todo.mapInArrow(_transitions, "number long, states string").collect()
        for i in range(len(r["states"]) // 5)
    }
    out, state = [], RECORD
    for i, r in enumerate(ranges):
        state = RECORD if r.start == 0 else state
        out.append(str(state))
        if i in found:
            state = int(found[i][state])
            if r.end == r.size and state == QUOTED:
                raise ValueError(f"{r.path}: a quote is never closed")
    return "".join(out)


def record_scan(spark: SparkSession, path: str, skip: int = 0, encoding: str = "utf-8", split_bytes: int | None = None) -> DataFrame:
    """(source_file, file_no, line_no = byte offset, cells) of the CSV records of a file or a folder, without the first `skip` of each file.

    Line feeds, returns before them, commas and quotes must be single bytes of their own (cp874 and UTF-8 keep them so). A quote that is never closed is an error.
    """
    spark.dataSource.register(RecordDataSource)
    ranges = files.byte_ranges(path, (), split_bytes or files.SPLIT_BYTES)
    states, tasks = range_states(spark, ranges, split_bytes or files.SPLIT_BYTES), task_count(spark, ranges)
    reader = spark.read.format("positioned_records").option("path", path).option("skip", skip).option("encoding", encoding).option("states", states).option("tasks", tasks)
    return (reader.option("split_bytes", split_bytes) if split_bytes else reader).load()


for _module in (files, decode, __import__(__name__, fromlist=["_"])):
    cloudpickle.register_pickle_by_value(_module)
