"""Files of token ids: round trips, damage, and the registered query against the library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest

from ledgerloom.llm import op5_range_coder as op5

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 257, 1030, 17_000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    documents = [
        rng.integers(0, 65_536, n), rng.zipf(1.2, n) % 49_408, np.arange(n) % 5, np.zeros(n), np.zeros(0), np.full(n, 65_535), (rng.random(n) < 0.001) * 40_000,
    ]
    documents = [d.astype("<u4").tobytes() for d in documents]
    names = [5, None, -3, 2**62, 5, 0, 7]
    got, lengths, ids = op5.read_file(op5.write_file(names, documents))
    assert got == names
    assert lengths.tolist() == [len(d) // 4 for d in documents]
    assert ids.tobytes() == b"".join(documents)


def test_repeated_ids_take_little_room():
    ids = np.tile(np.arange(100, dtype="<u4"), 400).tobytes()
    assert len(op5.write_file([1], [ids])) < len(ids) / 20


def test_blocks_do_not_depend_on_each_other():
    rng = np.random.default_rng(0)
    a, b = (np.sort(rng.integers(0, 900, n)) for n in (900, 400))
    together, alone = op5.encode_blocks([a, b]), op5.encode_blocks([b])
    assert together[1].tobytes() == alone[0].tobytes()
    assert (op5.decode_blocks(alone, np.array([400]))[0] == b).all()


def test_lanes_of_many_lengths_and_even_groups():
    rng = np.random.default_rng(1)
    blocks = [np.minimum(rng.zipf(1.3, n), 65_535) for n in (9000, 8193, 4097, 4096, 257, 64, 63, 9, 8, 1)]
    words = op5.encode_blocks(blocks)
    rows = op5.decode_blocks(words, np.array([len(b) for b in blocks]))
    assert all((row[: len(b)] == b).all() for row, b in zip(rows, blocks, strict=True))
    assert [len(range(*some.indices(10**6))) for some in op5._groups(op5.LANES + 1)] == [op5.LANES // 2, op5.LANES // 2 + 1]
    assert op5._groups(0) == []


def test_damage_is_found():
    data = bytearray(op5.write_file([1], [np.arange(500, dtype="<u4").tobytes()]))
    data[-20] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        op5.read_file(bytes(data))
    with pytest.raises(ValueError, match="not a file"):
        op5.read_file(b"other" + bytes(data))


def test_table(spark):
    from tokenizers import Tokenizer

    import __spark_entry__ as entry

    got = {r.doc_id: r for r in entry.queries()["op5_range_coder"](spark, SF).collect()}
    library, at = Tokenizer.from_file(WORDS), 0
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        row = got[r.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_nulls_repeats_and_empty(frame):
    docs = frame("doc_id long, text string, part string, extra int", [(3, "b c", "x", 1), (None, "z", "x", 2), (1, None, "x", 3), (3, "b c", "x", 4), (2, "", None, 5)])
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in op5.read_ids(op5.write_ids(docs, WORDS)).collect())
    assert got == [(0, 1, 1), (1, 2, 1), (2, 3, 3), (5, 3, 3), (8, None, 2)]
    assert op5.read_ids(op5.write_ids(docs.limit(0), WORDS)).count() == 0
