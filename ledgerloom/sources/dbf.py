"""Fixed-width ledger files (dBase layout) as a distributed scan.

Records have one length, so a file splits at header + i * record length and every task reads whole records.
The Python side only cuts fields out of the byte range; numbers and dates are parsed by Spark expressions.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from ledgerloom import session
from ledgerloom.sources import decode, files

CHUNK_BYTES = 8 << 20


@dataclass
class Field:
    name: str
    kind: str
    offset: int
    width: int
    decimals: int


@dataclass
class Layout:
    records: int
    header: int
    width: int
    fields: list[Field]


def read_layout(path: str) -> Layout:
    """Parse the file header (32 bytes, then 32 per field)."""
    head = files.read_range(path, 0, 32)
    records, header, width = struct.unpack("<IHH", head[4:12])
    block = files.read_range(path, 32, header - 32)
    fields, offset = [], 1
    for at in range(0, len(block) - 31, 32):
        if block[at] == 0x0D:
            break
        name = block[at : at + 11].split(b"\0")[0].decode("ascii").upper()
        size, decimals = block[at + 16], block[at + 17]
        fields.append(Field(name, chr(block[at + 11]), offset, size, decimals))
        offset += size
    return Layout(records, header, width, fields)


class DbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["path"]
        self.names = options["fields"].split(",")
        self.codepage = options.get("codepage", "cp874")
        self.date_field = options.get("date_field", "")
        self.start = options.get("start", "").encode()
        self.end = options.get("end", "").encode()
        self.split_bytes = int(options.get("split_bytes", files.SPLIT_BYTES))

    def partitions(self):
        return files.byte_ranges(self.paths, (".dbf",), self.split_bytes)

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        """Records that begin in the byte range."""
        if partition.start >= partition.end:
            return
        layout = read_layout(partition.path)
        by_name = {f.name: f for f in layout.fields}
        wanted = [by_name.get(n) for n in self.names]
        # trust the bytes over the count where a file was cut short
        records = min(layout.records, (partition.size - layout.header) // layout.width)
        line = max(-((layout.header - partition.start) // layout.width), 0)
        last = min(max(-((layout.header - partition.end) // layout.width), 0), records)
        step = max(CHUNK_BYTES // layout.width, 1)
        system, inner = files.file_system(partition.path)
        with system.open_input_file(inner) as handle:
            handle.seek(layout.header + line * layout.width)
            while line < last:
                count = min(step, last - line)
                data = handle.read(count * layout.width)
                yield self._batch(data, count, line, layout, by_name, wanted, partition)
                line += count

    def _in_range(self, raw: np.ndarray, f: Field | None) -> np.ndarray:
        """Records whose date lies in the range; a blank date, or a file without the field, is in none."""
        if not (self.start or self.end):
            return np.ones(len(raw), bool)
        if f is None:
            return np.zeros(len(raw), bool)
        cells = np.ascontiguousarray(raw[:, f.offset : f.offset + f.width])
        days = cells.view(f"S{f.width}").ravel()
        keep = ((cells >= ord("0")) & (cells <= ord("9"))).all(axis=1)
        if self.start:
            keep &= days >= self.start
        if self.end:
            keep &= days <= self.end
        return keep

    def _texts(self, cells: np.ndarray) -> pa.Array:
        """Cells of one field as text without trailing NUL and blank."""
        many, width = cells.shape
        whole = decode.texts(np.ascontiguousarray(cells).tobytes(), np.arange(many + 1, dtype=np.int64) * width, self.codepage)
        return pc.utf8_rtrim(whole, characters="\0 ")

    def _batch(self, data, count, line, layout, by_name, wanted, partition) -> pa.RecordBatch:
        raw = np.frombuffer(data, dtype=np.uint8, count=count * layout.width).reshape(count, layout.width)
        keep = raw[:, 0] != ord("*")
        if self.date_field:
            keep &= self._in_range(raw, by_name.get(self.date_field))
        raw = raw[keep]
        numbers = np.flatnonzero(keep) + line
        arrays = [
            pa.array([files.base_name(partition.path)] * len(raw), pa.string()),
            pa.array(np.full(len(raw), partition.file_no, dtype=np.int32)),
            pa.array(numbers.astype(np.int64)),
        ]
        for f in wanted:
            if f is None:
                arrays.append(pa.nulls(len(raw), pa.string()))
                continue
            arrays.append(self._texts(raw[:, f.offset : f.offset + f.width]))
        names = ["source_file", "file_no", "line_no", *[n.lower() for n in self.names]]
        return pa.RecordBatch.from_arrays(arrays, names=names)


class DbfDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledger_dbf"

    def schema(self) -> str:
        texts = ", ".join(f"`{n.lower()}` string" for n in self.options["fields"].split(","))
        return f"source_file string, file_no int, line_no bigint, {texts}"

    def reader(self, schema) -> DbfReader:
        return DbfReader(dict(self.options))


def _typed(f: Field) -> Column:
    """DBF kind -> Spark type: C text (no-break space as blank), N/F decimal, D date, L boolean; bad values null."""
    c = F.col(f.name.lower())
    if f.kind in "NF":
        return F.trim(c).try_cast(f"decimal({min(max(f.width, f.decimals + 1), 38)},{f.decimals})")
    if f.kind == "D":
        return F.try_to_date(c, "yyyyMMdd")
    if f.kind == "L":
        return F.when(F.upper(c).isin("T", "Y"), True).when(F.upper(c).isin("F", "N"), False)
    return F.translate(c, " ", " ")


def merged_fields(fields: Iterable[Field]) -> dict[str, Field]:
    """The fields of all files by name, in the order in which they first appear.

    Where files differ, numbers take the most places before and after the point, and a field of two kinds is text.
    """
    known: dict[str, Field] = {}
    for f in fields:
        old = known.get(f.name)
        if old is None:
            known[f.name] = Field(f.name, f.kind, f.offset, f.width, f.decimals)
            continue
        if old.kind != f.kind and {old.kind, f.kind} != {"N", "F"}:
            old.kind = "C"
        whole = max(old.width - old.decimals, f.width - f.decimals)
        old.decimals = max(old.decimals, f.decimals)
        old.width = whole + old.decimals
    return known


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = read_layout(row["path"]).fields
            columns = [[row["number"]] * len(found), list(range(len(found)))] + [[getattr(f, n) for f in found] for n in ("name", "kind", "width", "decimals")]
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["number", "place", "name", "kind", "width", "decimals"])


def all_fields(spark: SparkSession, paths: str) -> list[Field]:
    """The different fields of all files, in the order in which they first appear. The headers are read by tasks; what comes back are the layouts, not the files' lists."""
    found = [(i, path) for i, (path, _) in enumerate(files.list_files(paths, (".dbf",)))]
    if len(found) == 1:
        return read_layout(found[0][1]).fields
    if not found:
        return []
    headers = spark.createDataFrame(found, "number long, path string").repartition(min(len(found), 10 * session.shuffle_width(spark)))
    rows = headers.mapInArrow(_layouts, "number long, place long, name string, kind string, width long, decimals long")
    first = rows.groupBy("name", "kind", "width", "decimals").agg(F.min(F.struct("number", "place")).alias("at")).collect()
    return [Field(r["name"], r["kind"], 0, r["width"], r["decimals"]) for r in sorted(first, key=lambda r: tuple(r["at"]))]


def dbf_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str] | None = None,
    codepage: str = "cp874",
    date_field: str | None = None,
    start=None,
    end=None,
    split_bytes: int | None = None,
) -> DataFrame:
    """Typed records of one file, a folder or a list of files, with source_file, file_no and line_no.

    Deleted records are skipped; only `fields` are cut out; the date range is tested on the raw bytes.
    """
    paths = path if isinstance(path, str) else "\n".join(path)
    known = merged_fields(all_fields(spark, paths))
    wanted = [f.upper() for f in fields] if fields else list(known)
    spark.dataSource.register(DbfDataSource)
    reader = spark.read.format("ledger_dbf").option("path", paths).option("fields", ",".join(wanted)).option("codepage", codepage)
    if split_bytes:
        reader = reader.option("split_bytes", split_bytes)
    if date_field:
        reader = reader.option("date_field", date_field.upper())
        if start is not None:
            reader = reader.option("start", start.strftime("%Y%m%d"))
        if end is not None:
            reader = reader.option("end", end.strftime("%Y%m%d"))
    typed = [
        (_typed(known[n]) if n in known else F.lit(None).cast("string")).alias(n.lower()) for n in wanted
    ]
    return reader.load().select("source_file", "file_no", "line_no", *typed)


def dbf_multi_file_union(spark: SparkSession, paths: Sequence[str], fields: Sequence[str], **options) -> DataFrame:
    """The same table over several files in the order given (file_no), tagged with the file name."""
    return dbf_scan(spark, list(paths), fields, **options)


# the reader classes travel to the workers by value: no installation of this package is needed there
for _module in (files, decode, __import__(__name__, fromlist=["_"])):
    cloudpickle.register_pickle_by_value(_module)
