"""Bytes to text without a loop over cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def text_buffer(data: bytes, encoding: str) -> tuple[bytes, np.ndarray | None]:
    """The data as UTF-8, and for each of its bytes (and the end) where it stands there; None where they are the same.

    The encoding has one byte a character, so a table of 256 lengths tells the places.
    """
    table = bytes(range(256)).decode(encoding, "replace")
    raw = np.frombuffer(data, np.uint8)
    if not (raw > 127).any():
        return data, None
    lengths = np.array([len(c.encode()) for c in table], np.int64)
    return data.decode(encoding, "replace").encode(), np.concatenate(([0], np.cumsum(lengths[raw])))


def single_bytes(encoding: str) -> bool:
    """Whether every byte is a character of its own, the first 128 those of ASCII and some of the others too."""
    low, high = bytes(range(128)), bytes(range(128, 256))
    whole = low.decode(encoding, "replace") == low.decode("ascii") and len(high.decode(encoding, "replace")) == 128
    return whole and high.decode(encoding, "ignore") != ""


def texts(data: bytes, cuts: np.ndarray, encoding: str) -> pa.Array:
    """data[cuts[i]:cuts[i + 1]] as text; bytes that are no text become the replacement character.

    Only UTF-8 with broken characters, and encodings of several bytes a character other than UTF-8, go cell by cell.
    """
    if not single_bytes(encoding):
        try:
            if encoding.lower().replace("-", "") != "utf8":
                data.decode("ascii")
            data.decode("utf-8")
            moved = cuts
        except UnicodeDecodeError:
            return pa.array([data[a:b].decode(encoding, "replace") for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)], pa.string())
    else:
        data, places = text_buffer(data, encoding)
        moved = cuts if places is None else places[cuts]
    large = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(moved.astype(np.int64).tobytes()), pa.py_buffer(data))
    return large.cast(pa.string())


