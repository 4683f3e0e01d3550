"""Token ids in files of an adaptive context-mixing range coder.

A file holds a run of documents: their ids in one stream, cut into blocks of BLOCK ids. Every block starts with an empty model
and has a checksum of its own. At each id four predictors share the probability: the id that last followed the two ids before (order 2), the id that last
followed the id before (order 1), the counts of the block's ids so far (order 0, brought up to date at the places REFRESH), and the same chance for every id. Their
weights follow from how often each was the first to be right, kept apart for the cases that the two contexts agree or not and that the last id was predicted or not;
they change every LEARN ids, so the coder, which knows the ids, works on as many steps at once.
The mixture is one interval, by which a range coder with 64-bit state narrows its range. The blocks of a file are coded side by side, one numpy lane for each.

File: magic, then as little-endian integers: documents, blocks (32 bits); for each document: whether it has an id (8), id (64), number of ids (32); for each
block: ids, words, crc32 of its ids (32); then the blocks' words (32).

Defined results: null text is empty, so it has the end id alone; rows go by doc_id, null last, then by a hash of the text; repeated rows are written each; an
empty table gives no files and no rows; columns beside doc_id and text are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, body, ranges, read, travels_by_value
from ledgerloom.llm.token_ids import token_ids
from ledgerloom.session import materialise, shuffle_width

MAGIC = b"idrange2"
END = 2
BLOCK = 16_384
LANES = 512
MOST = 4 * BLOCK * LANES  # bytes of the ids of a file, a longer document aside
CHARS = 8_000_000  # texts that get their ids at once
REFRESH = (64, 256, 1024, 4096, 8192, 12_288)
LEARN = 64  # ids between two changes of the weights
VOCABULARY = 1 << 16
_SLOTS1, _SLOTS2 = 1 << 12, 1 << 14
_MIX = 40_503
_TOTAL = 24  # bits of the mixture's resolution
_ORDER0 = 15  # bits of the order-0 counts' resolution
_U32 = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
_SMALL = np.uint64(1 << 32)
_SHIFT = np.uint64(_TOTAL)


class Weights:
    """The weights of order 2, order 1, order 0 and the uniform chance for each lane and case, and the borders of their shares."""

    def __init__(self, lanes: int):
        self.weights = np.tile(np.array([2, 2, 8, 8], np.int64), (lanes * 4, 1))
        self.right = np.zeros(lanes * 16, np.int64)

    def shares(self, known: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(end of order 2, end of order 1, end of order 0, order 0 for one count, uniform chance for one id), in units of 1 / 2 ** _TOTAL."""
        w2, w1, w0, uniform = self.weights.T
        total = self.weights.sum(axis=1)
        # whole units for each count and each id, one at least, and a rest for the contexts
        each = 1 + (uniform if known else uniform + w0) * 254 // total
        count = 1 + w0 * 508 // total
        edge0 = (1 << _TOTAL) - (each << 16)
        edge1 = edge0 - (count << _ORDER0) if known else edge0
        edge2 = 1 + (edge1 - 2) * w2 // (w2 + w1)
        return edge2, edge1, edge0, count, each

    def count(self, case: np.ndarray, said: np.ndarray) -> None:
        """said: 0 to 3, the predictor that was the first to be right."""
        seen = np.bincount((4 * case + said).reshape(-1))
        self.right[: len(seen)] += seen

    def learn(self) -> None:
        self.weights += 4 * self.right.reshape(-1, 4)
        self.right[:] = 0
        full = self.weights.sum(axis=1) > 3996
        self.weights[full] = (self.weights[full] >> 1) + 1


def _spans(sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(from, to, lanes) of runs of steps in which neither the lanes, longest first, nor the model's tables change."""
    longest = int(sizes.max(initial=0))
    ends = sorted({0, 8, 16, 32, *range(0, longest, LEARN), *REFRESH, *sizes.tolist()})
    ends = [t for t in ends if t <= longest]
    return [(t, end, int(np.searchsorted(-sizes, -t, "left"))) for t, end in zip(ends, ends[1:], strict=False)]


def _learns(t: int) -> bool:
    return t % LEARN == 0 or t in (8, 16, 32) or t in REFRESH


def _counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order-0 counts of ids: (distinct ids, their counts scaled to a sum of 2 ** _ORDER0, the counts before them)."""
    ids = np.sort(ids)
    fresh = np.empty(len(ids), bool)
    fresh[0] = True
    np.not_equal(ids[1:], ids[:-1], out=fresh[1:])
    begins = fresh.nonzero()[0]
    share = np.empty(len(begins), np.int64)
    np.subtract(begins[1:], begins[:-1], out=share[:-1])
    share[-1] = len(ids) - begins[-1]
    seen = ids.take(begins)
    whole = np.maximum(share * ((1 << (_ORDER0 + 16)) // len(ids)) >> 16, 1)
    # what rounding leaves goes to the most frequent id
    top = int(share.argmax())
    whole[top] = 0
    rest = (1 << _ORDER0) - int(whole.sum())
    while rest < 1:  # many rare ids were rounded up
        big = int(whole.argmax())
        rest += int(whole[big]) // 2
        whole[big] -= whole[big] // 2
    whole[top] = rest
    return seen, whole, np.cumsum(whole) - whole


def _known(rows: np.ndarray, t: int, end: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts before, counts) of the ids t to end by the order-0 counts of the ids before t, (ids, n); an id not seen counts 0."""
    before, counts = np.empty((n, end - t), np.uint16), np.empty((n, end - t), np.uint16)
    place = np.zeros(VOCABULARY, np.int64)
    for lane in range(n):
        seen, whole, ahead = _counts(rows[lane, :t])
        place[seen] = np.arange(len(seen))
        ids = rows[lane, t:end]
        at = np.minimum(place.take(ids), len(seen) - 1)  # places of ids not seen are left from other lanes
        before[lane] = ahead.take(at)
        counts[lane] = np.where(seen.take(at) == ids, whole.take(at), 0)
    return np.ascontiguousarray(before.T), np.ascontiguousarray(counts.T)


def encode_blocks(blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The words of each block; blocks of ids below VOCABULARY, longest first.

    The ids are known, so all but the two context tables and the coder's state is computed for many steps at once.
    """
    lanes = len(blocks)
    sizes = np.array([len(b) for b in blocks], np.int64)
    rows = np.zeros((lanes, int(sizes.max(initial=0))), np.uint16)
    for i, b in enumerate(blocks):
        rows[i, : len(b)] = b
    stream = np.zeros((rows.shape[1] + 2, lanes), np.uint16)  # the ids of one step lie side by side, behind two steps of zeros
    stream[2:] = rows.T
    lane = np.arange(lanes)
    after1, after2, weights = np.zeros(lanes * _SLOTS1, np.uint16), np.zeros(lanes * _SLOTS2, np.uint16), Weights(lanes)
    hit = np.zeros(lanes, bool)
    low, reach = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    out, used = np.zeros((lanes, rows.shape[1] + 8), np.uint64), np.ones(lanes, np.int64)  # word 0 takes no carry
    begun, known, shares = 0, None, ()
    for t, end, n in _spans(sizes):
        if t in REFRESH:
            begun, known = t, _known(rows, t, min([r for r in REFRESH if r > t] + [rows.shape[1]]), n)
        if _learns(t):
            weights.learn()
            shares = [x.astype(np.int32) for x in weights.shares(known is not None)]
        ids = stream[t + 2 : end + 2, :n]
        last = stream[t + 1 : end + 1, :n].astype(np.int64)
        at1 = (last & (_SLOTS1 - 1)) + lane[:n] * _SLOTS1
        at2 = ((stream[t:end, :n].astype(np.int64) * _MIX + last) & (_SLOTS2 - 1)) + lane[:n] * _SLOTS2
        id1, id2 = np.empty((end - t, n), np.uint16), np.empty((end - t, n), np.uint16)
        for i in range(end - t):
            after1.take(at1[i], out=id1[i], mode="clip")
            after2.take(at2[i], out=id2[i], mode="clip")
            after1[at1[i]] = ids[i]
            after2[at2[i]] = ids[i]
        is2, right = ids == id2, ids == id1
        right |= is2
        hits = np.concatenate((hit[None, :n], right))
        hit[:n] = hits[-1]
        case = lane[:n] * 4 + 2 * (id1 == id2) + hits[:-1]
        edge2, edge1, edge0, count, each = (x.take(case) for x in shares)
        start, width = edge0 + ids * each, each
        is0 = False
        if known is not None:
            before, counts = (x[t - begun : end - begun, :n] for x in known)
            is0 = counts > 0
            start, width = np.where(is0, edge1 + before * count, start), np.where(is0, counts * count, width)
        start = np.where(right, np.where(is2, 0, edge2), start).astype(np.uint64)
        width = np.where(right, np.where(is2, edge2, edge1 - edge2), width).astype(np.uint64)
        weights.count(case, np.where(right, 1 - is2.view(np.int8), 3 - np.asarray(is0).view(np.int8)))
        _narrow(n, low, reach, start, width, out, used)
    for word in (low >> _U32, low & _LOW):
        out[lane, used] = word
        used += 1
    out = out[:, : int(used.max(initial=1))]
    while (out > _LOW).any():  # carries
        carry = out >> _U32
        out &= _LOW
        out[:, :-1] += carry[:, 1:]
    return [out[i, 1 : used[i]].astype("<u4") for i in range(lanes)]


def _narrow(n: int, low: np.ndarray, reach: np.ndarray, start: np.ndarray, width: np.ndarray, out: np.ndarray, used: np.ndarray) -> None:
    """The range coder over the intervals (steps, n) of the first n lanes; words go to out, where a word above 32 bits has a carry."""
    lows, over, full = np.empty(start.shape, np.uint64), np.empty(start.shape, bool), np.empty(start.shape, bool)
    at, span = low[:n].copy(), reach[:n].copy()
    step, shift, total, small, half = np.empty(n, np.uint64), np.empty(n, np.uint64), np.full(n, _SHIFT), np.full(n, _SMALL), np.full(n, _U32)
    for i in range(len(start)):
        np.right_shift(span, total, out=step)
        np.multiply(step, start[i], out=shift)
        moved = lows[i]
        np.add(at, shift, out=moved)
        np.less(moved, at, out=over[i])
        np.multiply(step, width[i], out=span)
        np.less(span, small, out=full[i])
        np.multiply(full[i], half, out=shift)
        np.left_shift(moved, shift, out=at)
        np.left_shift(span, shift, out=span)
    low[:n], reach[:n] = at, span
    before = np.cumsum(full, axis=0) - full + used[:n]
    steps, lane = np.nonzero(full)
    out[lane, before[steps, lane]] = lows[steps, lane] >> _U32
    steps, lane = np.nonzero(over)
    out[lane, before[steps, lane] - 1] += np.uint64(1)
    used[:n] = before[-1] + full[-1]


def _slots(rows: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Order-0 counts of the ids (n, ids) to look up: place is filled with the index of the id for each count, the result has (counts, counts before, id) packed by index."""
    packed = []
    for lane, ids in enumerate(rows):
        seen, whole, ahead = _counts(ids)
        place[lane] = np.repeat(np.arange(len(seen), dtype=np.uint16), whole)
        packed.append((whole << 32) | (ahead << 16) | seen)
    table = np.zeros((len(rows), max(map(len, packed))), np.uint64)
    for lane, p in enumerate(packed):
        table[lane, : len(p)] = p
    return table


def decode_blocks(words: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """(lanes, ids) of the blocks, longest first; row i is filled up to sizes[i]."""
    lanes = len(words)
    fed = np.zeros((lanes, max((len(w) for w in words), default=0) + 2), np.uint32)
    for i, w in enumerate(words):
        fed[i, : len(w)] = w
    stream = np.zeros((int(sizes.max(initial=0)), lanes), np.uint16)
    lane = np.arange(lanes)
    after1, after2, weights = np.zeros(lanes * _SLOTS1, np.uint16), np.zeros(lanes * _SLOTS2, np.uint16), Weights(lanes)
    place, packed, known = np.zeros((lanes, 1 << _ORDER0), np.uint16), np.zeros((lanes, 1), np.uint64), False
    flat, flat_fed = place.reshape(-1), fed.reshape(-1)
    all_code = (fed[:, 0].astype(np.uint64) << _U32) | fed[:, 1]
    all_reach = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    all_at, all_hit = lane * fed.shape[1] + 2, np.zeros(lanes, np.uint8)
    last, all_mixed = np.zeros(lanes, np.uint16), np.zeros(lanes, np.uint16)
    width_now = -1
    for t, end, n in _spans(sizes):
        if t in REFRESH:
            packed, known = _slots(np.ascontiguousarray(stream[:t, :n].T), place), True
        if _learns(t):
            weights.learn()
            of2, of1, of0, of_count, of_each = (x.astype(np.uint64) for x in weights.shares(known))
        if n != width_now:
            width_now = n
            code, reach, at, hit, mixed = (x[:n] for x in (all_code, all_reach, all_at, all_hit, all_mixed))
            last = last[:n]
            # of order 2, order 1, order 0 and the uniform chance, one behind the other
            ids, starts, widths = np.zeros(4 * n, np.uint16), np.zeros(4 * n, np.uint64), np.zeros(4 * n, np.uint64)
            id2, id1, id0, id_rest = ids.reshape(4, n)
            _, edge2, start, start_rest = starts.reshape(4, n)
            width2, width1, width, each = widths.reshape(4, n)
            slot, k, share, which = np.empty(n, np.uint16), np.empty(n, np.uint16), np.empty(n, np.uint8), np.empty(n, np.int8)
            # columns of constants: numpy takes longer over single numbers
            slots1, slots2, mix = (np.full(n, x, np.uint16) for x in (_SLOTS1 - 1, _SLOTS2 - 1, _MIX))
            shift, small, half, stride = np.full(n, _SHIFT), np.full(n, _SMALL), np.full(n, _U32), np.full(n, n)
            at1, at2, pick = (np.empty(n, np.int64) for _ in range(3))
            edge1, edge0, count, step, value, one, word = (np.empty(n, np.uint64) for _ in range(7))
            before, counts = word.view("<u2")[1::4], word.view("<u2")[2::4]
            eq, full = np.empty(n, bool), np.empty(n, bool)
            eq8 = eq.view(np.uint8)
            row1, row2, row_place, row_order0, four = lane[:n] * _SLOTS1, lane[:n] * _SLOTS2, lane[:n] << _ORDER0, lane[:n] + 2 * n, 4 * lane[:n]
        row_packed, flat_packed = lane[:n] * packed.shape[1], packed.reshape(-1)
        cases, by1, by2, by_rest = np.empty((end - t, n), np.int64), *(np.empty((end - t, n), bool) for _ in range(3))
        for found, case, in1, in2, rare in zip(stream[t:end, :n], cases, by1, by2, by_rest, strict=True):
            # what the contexts say
            np.bitwise_and(last, slots1, out=slot)
            np.add(row1, slot, out=at1)
            after1.take(at1, out=id1, mode="clip")
            np.add(mixed, last, out=slot)
            np.bitwise_and(slot, slots2, out=slot)
            np.add(row2, slot, out=at2)
            after2.take(at2, out=id2, mode="clip")
            np.equal(id1, id2, out=eq)
            np.left_shift(eq8, 1, out=share)
            np.add(share, hit, out=share)
            np.add(four, share, out=case)
            of2.take(case, out=edge2, mode="clip")
            np.copyto(width2, edge2)
            of1.take(case, out=edge1, mode="clip")
            of0.take(case, out=edge0, mode="clip")
            # the share that holds the value
            np.right_shift(reach, shift, out=step)
            np.floor_divide(code, step, out=value)
            np.less(value, edge1, out=in1)
            np.less(value, edge2, out=in2)
            np.greater_equal(value, edge0, out=rare)
            # order 0; lanes that lie elsewhere look up anything and are put right below
            if known:
                of_count.take(case, out=count, mode="clip")
                np.subtract(value, edge1, out=start)
                np.floor_divide(start, count, out=start)
                np.add(start.view(np.int64), row_place, out=pick)
                flat.take(pick, out=k, mode="clip")
                np.add(row_packed, k, out=pick)
                flat_packed.take(pick, out=word, mode="clip")
                np.copyto(id0, word, casting="unsafe")
                np.copyto(start, before)
                np.multiply(start, count, out=start)
                np.add(start, edge1, out=start)
                np.copyto(width, counts)
                np.multiply(width, count, out=width)
            # the uniform chance
            of_each.take(case, out=each, mode="clip")
            np.subtract(value, edge0, out=one)
            np.floor_divide(one, each, out=one)
            np.copyto(id_rest, one, casting="unsafe")
            np.multiply(one, each, out=one)
            np.add(one, edge0, out=start_rest)
            # the contexts
            np.subtract(edge1, edge2, out=width1)
            # the one that is meant
            np.subtract(rare.view(np.int8), in1.view(np.int8), out=which)
            np.subtract(which, in2.view(np.int8), out=which)
            np.copyto(pick, which)
            np.multiply(pick, stride, out=pick)
            np.add(pick, row_order0, out=pick)
            ids.take(pick, out=found, mode="clip")
            starts.take(pick, out=word, mode="clip")
            widths.take(pick, out=value, mode="clip")
            # the coder
            np.multiply(word, step, out=word)
            np.subtract(code, word, out=code)
            np.multiply(value, step, out=reach)
            np.less(reach, small, out=full)
            some = full.nonzero()[0]
            if len(some):
                next_word = at.take(some)
                code[some] = (code.take(some) << _U32) | flat_fed.take(next_word, mode="clip")
                reach[some] = reach.take(some) << _U32
                at[some] = next_word + 1
            # the tables
            after1[at1] = found
            after2[at2] = found
            np.multiply(last, mix, out=mixed)
            last = found
            np.copyto(hit, in1.view(np.uint8))
        weights.count(cases, np.where(by1, 1 - by2.view(np.int8), 2 + by_rest.view(np.int8)))
    return np.ascontiguousarray(stream.T)


def _groups(blocks: int) -> list[slice]:
    """Blocks that are coded side by side: up to LANES, about as many in each group."""
    groups = -(-blocks // LANES)
    return [slice(blocks * i // groups, blocks * (i + 1) // groups) for i in range(groups)]


def write_file(doc_ids: list[int | None], documents: list[bytes]) -> bytes:
    """A file of documents given by their ids as little-endian 32-bit bytes."""
    stream = np.frombuffer(b"".join(documents), "<u4")
    if len(stream) and int(stream.max()) >= VOCABULARY:
        raise ValueError("ids have to be below 65,536")
    blocks = [stream[i : i + BLOCK] for i in range(0, len(stream), BLOCK)]
    coded = [w for some in _groups(len(blocks)) for w in encode_blocks(blocks[some])]
    head = np.array([len(doc_ids), len(blocks)], "<u4").tobytes()
    index = b"".join(
        (np.array([d is not None for d in doc_ids], "u1").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([len(x) // 4 for x in documents], "<u4").tobytes())
    )
    sizes = np.array([[len(b), len(w), zlib.crc32(b.tobytes())] for b, w in zip(blocks, coded, strict=True)], "<u4").tobytes()
    return b"".join((MAGIC, head, index, sizes, *[w.tobytes() for w in coded]))


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, number of ids of each, ids of all) of a file; a block that fails its checksum is an error."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a file of ids")
    at = len(MAGIC)

    def take(kind: str, many: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, many, at)
        at += out.nbytes
        return out

    documents, many = (int(x) for x in take("<u4", 2))
    named, doc_ids, lengths = take("u1", documents), take("<i8", documents), take("<u4", documents)
    table = take("<u4", 3 * many).reshape(many, 3)
    words = [take("<u4", int(n)) for n in table[:, 1]]
    parts = []
    for some in _groups(many):
        rows = decode_blocks(words[some], table[some, 0].astype(np.int64))
        for k, (size, _, crc) in enumerate(table[some]):
            block = rows[k, :size].astype("<u4")
            if zlib.crc32(block.tobytes()) != crc:
                raise ValueError(f"block {some.start + k} is damaged")
            parts.append(block)
    ids = np.concatenate(parts) if parts else np.zeros(0, "<u4")
    return [int(d) if n else None for d, n in zip(doc_ids, named, strict=True)], lengths.astype(np.int64), ids


def write_ids(docs: DataFrame, file: str, end: int = END) -> DataFrame:
    """A written table of files (part, place, n_ids, data) in the order of doc_id: parts are doc_id ranges, a file has about LANES blocks."""
    tail = end.to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(file, False)
        part, place, chars = None, 0, 0
        names, texts, documents = [], [], []  # names of the documents that have ids, then of the texts that have none yet

        def filed(all_of_them: bool) -> Iterator[pa.RecordBatch]:
            nonlocal place
            documents.extend(ids + tail for ids in encoder.encode(texts))
            texts.clear()
            while documents:
                ends = np.cumsum([len(x) for x in documents])
                if ends[-1] < MOST and not all_of_them:
                    return
                many = max(int(np.searchsorted(ends, MOST, "right")), 1)
                data = write_file(names[:many], documents[:many])
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "place": pa.array([place], pa.int32()), "n_ids": [int(ends[many - 1]) // 4], "data": [data]})
                del names[:many], documents[:many]
                place += 1

        for batch in batches:
            for own, name, text in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text")), strict=True):
                if own != part:
                    yield from filed(True)
                    part, place, chars = own, 0, 0
                names.append(name)
                texts.append(text)
                chars += len(text)
                if chars >= CHARS:
                    yield from filed(False)
                    chars = 0
        yield from filed(True)

    part, _ = ranges(docs, "doc_id")
    rows = docs.select("doc_id", body().alias("text")).withColumn("part", part).withColumn("tie", F.xxhash64("text"))
    # by range: parts are numbered, and a hash would put several into one task
    rows = rows.repartitionByRange(shuffle_width(docs.sparkSession), "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_last(), "tie").drop("tie")
    with arrow_batches(docs.sparkSession, 256):
        return materialise(rows.mapInArrow(write, "part int, place int, n_ids long, data binary"), "id-files")


def read_ids(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, lengths, ids = read_file(row["data"])
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([row["part"]] * len(names), pa.int32()),
                        "place": pa.array([row["place"]] * len(names), pa.int32()),
                        "doc_id": pa.array(names, pa.int64()),
                        "inside": ends - lengths,
                        "n_tokens": lengths,
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    sizes = files.select("part", "place", "n_ids")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("file_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select("part", "place", (F.col("part_start") + F.col("file_start")).alias("file_start"))
    with arrow_batches(files.sparkSession, 1):
        documents = files.repartitionByRange(shuffle_width(files.sparkSession), "part", "place").mapInArrow(opened, "part int, place int, doc_id long, inside long, n_tokens long, ids_crc32 long")
        documents = materialise(documents, "id-documents")
    return documents.join(materialise(starts, "id-starts"), ["part", "place"]).select("doc_id", (F.col("file_start") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def op5_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_ids(write_ids(read(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")))


travels_by_value(__name__)
