"""Line-oriented files with a stable position per line or record: report dumps, sheets, link lists.

Positions are byte offsets, so a big file splits into ranges and its lines still have a total order. Dumps and sheets are read as CSV records (see
`records`), plain lines as lines.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from ledgerloom.sources import files, records

CHUNK_BYTES = 8 << 20


class LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["path"]
        self.skip = int(options.get("skip", 0))
        self.encoding = options.get("encoding", "utf-8")
        self.split_bytes = int(options.get("split_bytes", files.SPLIT_BYTES))

    def _body_start(self, path: str, size: int) -> int:
        """Offset after the skipped head lines."""
        at, left = 0, self.skip
        while left and at < size:
            data = files.read_range(path, at, 1 << 16)
            ends = [i for i, b in enumerate(data) if b == 10][:left]
            left -= len(ends)
            at += ends[-1] + 1 if left == 0 else len(data)
        return at if left == 0 else size

    def partitions(self):
        return files.byte_ranges(self.paths, (), self.split_bytes)

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        """Lines that begin in [start, end), behind the head lines; the last one is read past the end of the range."""
        if partition.start >= partition.end:
            return
        body = self._body_start(partition.path, partition.size)
        start = max(partition.start, body)
        if start >= partition.end:
            return
        system, inner = files.file_system(partition.path)
        with system.open_input_file(inner) as handle:
            at = start
            if at > body:
                # a line beginning exactly at start is ours: look at the byte before it
                handle.seek(at - 1)
                at -= 1
                while True:
                    data = handle.read(CHUNK_BYTES)
                    if not data:
                        return
                    cut = data.find(b"\n")
                    if cut >= 0:
                        at += cut + 1
                        break
                    at += len(data)
            handle.seek(at)
            pending, pending_at = b"", at
            while pending_at < partition.end:
                data = handle.read(CHUNK_BYTES)
                block = pending + data
                if not block:
                    return
                cut = block.rfind(b"\n") + 1 if data else len(block)
                if cut == 0:
                    pending = block
                    continue
                yield from self._lines(block[:cut], pending_at, partition)
                pending_at += cut
                pending = block[cut:]
                if not data:
                    return

    def _lines(self, block: bytes, offset: int, partition) -> Iterator[pa.RecordBatch]:
        marks = np.flatnonzero(np.frombuffer(block, dtype=np.uint8) == 10)
        starts = np.concatenate(([0], marks + 1))
        starts = starts[starts < len(block)]
        ours = starts[starts + offset < partition.end]
        if len(ours) == 0:
            return
        texts = pa.array(block.decode(self.encoding, "replace").split("\n")[: len(ours)], pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([files.base_name(partition.path)] * len(ours), pa.string()),
                pa.array(np.full(len(ours), partition.file_no, dtype=np.int32)),
                pa.array((ours + offset).astype(np.int64)),
                pc.utf8_rtrim(texts, characters="\r"),
            ],
            names=["source_file", "file_no", "line_no", "value"],
        )


class LineDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "positioned_lines"

    def schema(self) -> str:
        return "source_file string, file_no int, line_no bigint, value string"

    def reader(self, schema) -> LineReader:
        return LineReader(dict(self.options))


def line_scan(
    spark: SparkSession, path: str | Sequence[str], skip: int = 0, encoding: str = "utf-8", split_bytes: int | None = None
) -> DataFrame:
    """(source_file, file_no, line_no = byte offset, value) without the first `skip` lines of each file.

    The encoding must keep the line feed a single byte of its own (cp874 and UTF-8 do).
    """
    spark.dataSource.register(LineDataSource)
    paths = path if isinstance(path, str) else "\n".join(path)
    reader = spark.read.format("positioned_lines").option("path", paths).option("skip", skip).option("encoding", encoding)
    if split_bytes:
        reader = reader.option("split_bytes", split_bytes)
    return reader.load()


def cell_names(n: int) -> list[str]:
    """A to Z, AA, AB, ... as a sheet names its columns."""
    names = []
    for i in range(n):
        name, i = "", i + 1
        while i:
            i, letter = divmod(i - 1, 26)
            name = chr(ord("A") + letter) + name
        names.append(name)
    return names


# fixed values: words that dumps write for an absent value
ABSENT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def _cells(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cells by position; short records are filled with nulls, records with too many cells are dropped, words for absent values are nulls."""
    cells = [F.get("cells", F.lit(i)) for i in range(len(names))]
    known = [F.when(~c.isin(*ABSENT), c).alias(n) for c, n in zip(cells, names, strict=True)]
    return found.where(F.size("cells") <= len(names)).select("source_file", "file_no", "line_no", *known)


def report_csv_scan(
    spark: SparkSession, path: str | Sequence[str], skiprows: int, ncols: int, encoding: str = "cp874", split_bytes: int | None = None
) -> DataFrame:
    """Headerless report dump: cells A, B, C, ... with file and position of their record. A quoted cell may hold commas, quotes and line feeds."""
    paths = path if isinstance(path, str) else "\n".join(path)
    return _cells(records.record_scan(spark, paths, skiprows, encoding, split_bytes), cell_names(ncols))


# fixed values: column titles of the point-of-sale sheet (quantity, unit price)
SHEET_TITLES = ("SKU", "จำนวน", "ราคาสินค้า/ชิ้น")


def sheet_lines_scan(
    spark: SparkSession, sheets: dict[str, str], skiprows: int = 5, encoding: str = "utf-8", split_bytes: int | None = None
) -> DataFrame:
    """SKU, quantity and unit price of the CSV exports {store: path}: skiprows records, the titles, then data."""
    out = None
    layouts: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for store, path in sheets.items():
        for file, _ in files.list_files(path):
            layouts.setdefault((store, tuple(_titles(file, skiprows, encoding))), []).append(file)
    for (store, names), paths in layouts.items():
        found = records.record_scan(spark, "\n".join(paths), skiprows + 1, encoding, split_bytes)
        cells = _cells(found, [f"c{i}" for i in range(len(names))])
        sku, qty, price = (F.col(f"c{names.index(t)}") for t in SHEET_TITLES)
        rows = cells.select(
            F.lit(store).alias("store"),
            "source_file",
            "line_no",
            sku.alias("sku"),
            F.trim(qty).try_cast("double").cast("int").alias("quantity"),
            F.trim(price).try_cast("double").alias("unit_price"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _titles(path: str, skiprows: int, encoding: str) -> list[str]:
    """The title record of a file, however long the records before it are."""
    size = 1 << 16
    while True:
        data = files.read_range(path, 0, size)
        ends = records.Quotes(data).record_ends(records.RECORD)
        if len(ends) > skiprows or len(data) < size:
            break
        size *= 4
    ends = [-1, *ends.tolist(), *([] if data.endswith(b"\n") else [len(data)])]
    title = data[ends[skiprows] + 1 : ends[skiprows + 1]] + b"\n" if len(ends) > skiprows + 1 else b""
    _, cells = records.records(title, encoding)
    if not len(cells):
        raise ValueError(f"{path} has no title line")
    return [t.strip() for t in cells[0].as_py()]


def link_list_scan(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """One link per line, trimmed; each once unless distinct=False."""
    links = spark.read.text(path).select(F.trim("value").alias("url")).where("url <> ''")
    return links.distinct() if distinct else links


for _module in (files, __import__(__name__, fromlist=["_"])):
    cloudpickle.register_pickle_by_value(_module)
