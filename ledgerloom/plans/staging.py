"""Files derived from the driver tables, written by Spark into the shared folder for the scans to read."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import session
from ledgerloom.sources import files

# name, kind (C, N, D), width, decimals
DbfField = tuple[str, str, int, int]


def dbf_header(fields: Sequence[DbfField], records: int) -> bytes:
    width = 1 + sum(f[2] for f in fields)
    head = struct.pack("<BBBBIHH20x", 3, 98, 6, 15, records, 32 + 32 * len(fields) + 1, width)
    for name, kind, size, decimals in fields:
        head += struct.pack("<11sc4xBB14x", name.encode("ascii"), kind.encode("ascii"), size, decimals)
    return head + b"\r"


def dbf_record(row, fields: Sequence[DbfField], deleted: bool, codepage: str = "cp874") -> bytes:
    out = b"*" if deleted else b" "
    for value, (_, kind, size, _) in zip(row, fields, strict=True):
        text = "" if value is None else str(value)
        data = text.encode(codepage, "replace")[:size]
        out += data.rjust(size) if kind == "N" else data.ljust(size)
    return out


FILE_BYTES = 32 << 20


def _write_partition(batches: Iterator[pd.DataFrame], folder: str, fields: Sequence[DbfField]) -> Iterator[pd.DataFrame]:
    """Files of at most about FILE_BYTES for each file name and task, as a header has to know the records; a task tried again writes the same files again."""
    task = TaskContext.get().partitionId()
    bodies: dict[str, list[bytes]] = {}
    written: dict[str, int] = {}
    rows = 0
    width = len(dbf_record([None] * len(fields), fields, False))

    def write(name: str) -> None:
        records = bodies.pop(name)
        part = written[name] = written.get(name, -1) + 1
        system, inner = files.file_system(f"{folder}/{name}-{task:05d}-{part:04d}.dbf")
        with system.open_output_stream(inner) as out:
            out.write(dbf_header(fields, len(records)) + b"".join(records) + b"\x1a")

    for batch in batches:
        names = [f[0].lower() for f in fields]
        values = batch[names].itertuples(index=False, name=None)
        for row, name, deleted in zip(values, batch["__file"], batch["__deleted"], strict=True):
            held = bodies.setdefault(name, [])
            held.append(dbf_record(row, fields, bool(deleted)))
            rows += 1
            if len(held) * width >= FILE_BYTES:
                write(name)
    for name in list(bodies):
        write(name)
    yield pd.DataFrame({"rows": [rows]})


def _text(df: DataFrame, field: DbfField) -> Column:
    name, kind, _, decimals = field
    c = F.col(name.lower())
    if kind == "D":
        return F.date_format(c, "yyyyMMdd").alias(name.lower())
    if kind == "N":
        return c.cast(f"decimal(20,{decimals})").cast("string").alias(name.lower())
    return c.cast("string").alias(name.lower())


def write_dbf(df: DataFrame, fields: Sequence[DbfField], file: Column, deleted: Column) -> str:
    """Write df as ledger files; returns the folder."""
    spark = df.sparkSession
    folder = session.scratch_path(spark, "dbf")
    system, inner = files.file_system(folder)
    system.create_dir(inner, recursive=True)
    rows = df.select(*[_text(df, f) for f in fields], file.alias("__file"), deleted.alias("__deleted"))
    layout = list(fields)
    rows.mapInPandas(lambda it: _write_partition(it, folder, layout), "rows bigint").agg(F.sum("rows")).collect()
    return folder


def write_lines(df: DataFrame, value: Column, label: str, encoding: str = "utf-8") -> str:
    folder = session.scratch_path(df.sparkSession, label)
    if encoding == "utf-8":
        df.select(value.alias("value")).write.text(folder)
        return folder
    _write_encoded(df.select(value.alias("value")), folder, encoding)
    return folder


def _write_encoded_partition(batches: Iterator[pd.DataFrame], folder: str, encoding: str, head: str) -> Iterator[pd.DataFrame]:
    task = TaskContext.get().partitionId()
    system, inner = files.file_system(f"{folder}/part-{task:05d}.csv")
    count = 0
    with system.open_output_stream(inner) as out:
        out.write(head.encode(encoding, "replace"))
        for batch in batches:
            for value in batch["value"]:
                out.write(value.encode(encoding, "replace") + b"\r\n")
                count += 1
    yield pd.DataFrame({"rows": [count]})


def _write_encoded(df: DataFrame, folder: str, encoding: str, head: str = "") -> None:
    system, inner = files.file_system(folder)
    system.create_dir(inner, recursive=True)
    df.mapInPandas(lambda it: _write_encoded_partition(it, folder, encoding, head), "rows bigint").agg(F.sum("rows")).collect()


def write_dump(df: DataFrame, value: Column, label: str, head: str, encoding: str = "cp874") -> str:
    """Text files with `head` at the top of each."""
    folder = session.scratch_path(df.sparkSession, label)
    _write_encoded(df.select(value.alias("value")), folder, encoding, head)
    return folder


for _module in (files, __import__(__name__, fromlist=["_"])):
    cloudpickle.register_pickle_by_value(_module)
