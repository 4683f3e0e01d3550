"""Byte-range access to files on any file system PyArrow can open (local, hdfs, s3, gs)."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql.datasource import InputPartition

SPLIT_BYTES = 64 << 20


@dataclass
class FileRange(InputPartition):
    """Bytes [start, end) of a file of `size` bytes, the `file_no`-th of the scan."""

    path: str
    file_no: int
    start: int
    end: int
    size: int


def byte_ranges(paths: str, suffixes: tuple[str, ...], split_bytes: int) -> list[FileRange]:
    """Splits from the file sizes alone; the tasks find the record or line borders themselves."""
    ranges = [
        FileRange(path, number, start, min(start + split_bytes, size), size)
        for number, (path, size) in enumerate(list_files(paths, suffixes))
        for start in range(0, size, split_bytes)
    ]
    return ranges or [FileRange("", 0, 0, 0, 0)]


_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]+):")
# Hadoop's names of schemes that PyArrow knows under another one
_SAME = {"s3a": "s3", "s3n": "s3"}
_KNOWN = {"file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss"}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path; a scheme that PyArrow cannot open is an error, never a local folder."""
    scheme = _SCHEME.match(path)
    if scheme is None:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    name, rest = scheme[1].lower(), path[scheme.end() :]
    name = _SAME.get(name, name)
    if name not in _KNOWN:
        raise ValueError(f"no reader for {scheme[1]}: paths ({path})")
    if name == "file":
        rest = "//" + os.path.abspath("/" + rest.lstrip("/"))
    return pafs.FileSystem.from_uri(f"{name}:{rest}")


def list_files(paths: str, suffixes: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """(path, size) of the files named or contained, in the order given, folders sorted by name."""
    found = []
    for path in paths.split("\n"):
        system, inner = file_system(path)
        scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
        info = system.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == pafs.FileType.File:
            found.append((scheme + inner, info.size))
            continue
        children = system.get_file_info(pafs.FileSelector(inner, recursive=True))
        for child in sorted(children, key=lambda c: c.path):
            hidden = child.base_name.startswith(("_", "."))
            if child.type == pafs.FileType.File and not hidden and child.path.lower().endswith(suffixes or ("",)):
                found.append((scheme + child.path, child.size))
    return found


def read_range(path: str, start: int, length: int) -> bytes:
    system, inner = file_system(path)
    with system.open_input_file(inner) as handle:
        handle.seek(start)
        return handle.read(length)


def base_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]
