"""Near duplicates by SimHash, linked through a segment-popcount embedding.

A text's fingerprint has 64 bits: bit b is set where more than half of its shingles' XXH64 values have it. Fingerprints that differ in at most
`distance` bits are linked, and the classes are the connected components of the links.

The candidates come from an embedding: a fingerprint is cut into 32 segments of two bits, and the numbers of set bits in them are its coordinates. The
Manhattan distance of two points is never above the number of differing bits. The coordinates stand in two parts. Points within the distance of
each other are near in one of the parts: within REACH[0] in the first or within REACH[1] in the second (the reaches add up to the distance less one). Each
part is a grid with a cell for every point of it, and the range join is an equi join on cells: for reach 2 a fingerprint enters its own cell
and the neighbours one step up or down along a coordinate (two points within 2 have a cell within 1 of both), for reach 1 its own and those one step up.
Fingerprints that meet in a cell are verified exactly by counting the bits in which they differ.

Only distinct fingerprints take part. Inside a cell links that join classes are kept, not all pairs. A cell of more than MOST fingerprints is
dealt to chunks, each with the cell's least fingerprint as a member; after a first round of components, members outside a cell's largest class
meet the cell's chunks once more, in tasks of one pair of chunks, and only where their classes differ. So no link is lost, and a
group of near copies costs about one comparison with its class, not one of all pairs.

Defined results: null text and texts without words have the fingerprint zero and are linked like any other; texts of fewer words than a shingle are
one shingle; a component's id is the least non-null doc_id in it, null where all are null; repeated rows stay rows of their own; an empty table gives no
rows; other columns are not read. A text is one value of one row and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, body, read, small_batches, travels_by_value
from ledgerloom.llm.components import components
from ledgerloom.session import materialise

WORDS = 4
SEED = 42
DISTANCE = 4
FIRST = 18  # segments of the first part; the second has the other 14
SEGMENTS = 32
MOST = 512
_PAIRS = 4_000_000  # pairs compared side by side
_HASHES = 1 << 16
_ODD = 0x5555555555555555


def fingerprint(text: Column, words: int = WORDS, seed: int = SEED) -> Column:
    """The 64 bits of the text as a signed number; ASCII letters are lower-cased, words are parted by blanks and characters 9 to 13."""

    @F.arrow_udf("bigint")
    def printed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        digest = xxhash.xxh64_digest
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                tokens = (text or "").encode().lower().split()  # of bytes: ASCII rules only
                if not tokens:
                    out.append(0)
                    continue
                joined = b" ".join(tokens)
                begins = np.cumsum([0, *map(len, tokens)]) + np.arange(len(tokens) + 1)
                many = max(len(tokens) - words + 1, 1)
                firsts, ends = begins[:many].tolist(), (begins[min(words, len(tokens)) :] - 1).tolist()
                set_ = np.zeros(64, np.int64)
                for i in range(0, many, _HASHES):
                    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(firsts[i : i + _HASHES], ends[i : i + _HASHES], strict=True)])
                    set_ += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
                out.append(int.from_bytes(np.packbits(2 * set_ > many).tobytes(), "big", signed=True))
            yield pa.array(out, pa.int64())

    return printed(text)


def embedded(print_: Column) -> Column:
    """The numbers of set bits of the 32 segments, two bits each, as one number (bitwise, as a difference could overflow)."""
    half = F.shiftrightunsigned(print_, 1)
    both, one = print_.bitwiseAND(half).bitwiseAND(F.lit(_ODD)), print_.bitwiseXOR(half).bitwiseAND(F.lit(_ODD))
    return F.shiftleft(both, 1).bitwiseOR(one)


def reaches(distance: int) -> tuple[int, int]:
    """Points within the distance are within the first reach in the first part or within the second in the second."""
    if not 1 <= distance <= 5:
        raise ValueError("cells are laid out for distances of 1 to 5")
    return distance // 2, distance - 1 - distance // 2


def cells(point: Column, distance: int = DISTANCE) -> Column:
    """The cells a point enters, over both parts."""
    out = []
    for begin, end, reach, tag in zip((0, FIRST), (FIRST, SEGMENTS), reaches(distance), (0, 1 << 40), strict=True):
        part = F.shiftrightunsigned(point, 2 * begin).bitwiseAND(F.lit((1 << 2 * (end - begin)) - 1))
        out.append(part + tag)
        for i in range(end - begin if reach else 0):
            count = F.shiftrightunsigned(part, 2 * i).bitwiseAND(F.lit(3))
            out.append(F.when(count < 2, part + (tag + (1 << 2 * i))))
            if reach == 2:
                out.append(F.when(count > 0, part + (tag - (1 << 2 * i))))
    return F.array_compact(F.array(*out))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number in the component of each of the nodes 0 to n - 1 under the links (a, b)."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def cell_links(group: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the classes inside each group of neighbouring rows with the same number."""
    n = len(group)
    firsts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.empty(0, np.int64)
    sizes = np.diff(np.append(firsts, n))
    behind = np.repeat(firsts + sizes, sizes) - np.arange(n) - 1  # rows of the group behind a row
    at, found = np.flatnonzero(behind > 0), [np.empty((2, 0), np.int64)]
    shift = 1
    while len(at):
        near = at[np.bitwise_count(prints[at] ^ prints[at + shift]) <= distance]
        found.append(np.stack([near, near + shift]))
        shift += 1
        at = at[behind[at] >= shift]
    a, b = np.concatenate(found, axis=1)
    root = roots(n, a, b)
    moved = np.flatnonzero(root != np.arange(n))
    return prints[root[moved]], prints[moved]


def _as_links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([a.view(np.int64), b.view(np.int64)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _link_sorted(distance: int):
    """mapInArrow function over rows (cell, chunk, print) sorted by cell and chunk; a group that goes on in the next batch waits for it."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            rows = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            cell, chunk, prints = rows
            new = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (chunk[1:] != chunk[:-1])))
            held = [r[new[-1] :] for r in rows]
            yield from compared(np.repeat(np.arange(len(new)), np.diff(np.append(new, len(cell))))[: new[-1]], prints[: new[-1]])
        yield from compared(np.zeros(len(held[0]), np.int64), held[2])

    def compared(group: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.bincount(group) if len(group) else np.empty(0, np.int64)
        share = (np.cumsum(sizes * sizes) // _PAIRS)[group] if len(group) else group
        for s in np.unique(share):
            mine = share == s
            a, b = cell_links(group[mine], prints[mine].view(np.uint64), distance)
            if len(a):
                yield _as_links(a, b)

    return link


def _link_chunks(distance: int):
    """mapInArrow function over pairs of chunks: links between the classes of members that are near and of different classes."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                strays, members = (np.array(row[c], np.int64) for c in ("strays", "members"))
                stray_roots, member_roots = (np.array(row[c], np.int64) for c in ("stray_roots", "member_roots"))
                near = np.bitwise_count(strays.view(np.uint64)[:, None] ^ members.view(np.uint64)[None, :]) <= distance
                near &= stray_roots[:, None] != member_roots[None, :]
                a, b = np.nonzero(near)
                if len(a):
                    yield _as_links(stray_roots[a], member_roots[b])

    return link


def links(prints: DataFrame, distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """(a, b): links among the distinct fingerprints of column print that leave the components of all links as they are; prints is a written table."""
    spark = prints.sparkSession
    entered = prints.select(F.explode(cells(embedded(F.col("print")), distance)).alias("cell"), "print")
    counts = entered.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("least"))
    hot = materialise(counts.where(F.col("n") > most).withColumn("chunks", F.ceil(F.col("n") / most).cast("long")), "simhash-hot-cells")
    dealt = entered.join(hot, "cell", "left").select("cell", F.coalesce(F.pmod(F.xxhash64("print"), F.col("chunks")), F.lit(0)).alias("chunk"), "print")
    leads = hot.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.col("least").alias("print"))
    grouped = dealt.unionByName(leads).repartition("cell", "chunk").sortWithinPartitions("cell", "chunk")
    with arrow_batches(spark, 1 << 16):
        first = materialise(grouped.mapInArrow(_link_sorted(distance), "a long, b long"), "simhash-links")
    if hot.isEmpty():
        return first
    tops = materialise(components(first), "simhash-tops")
    members = (
        entered.join(hot, "cell")
        .join(tops.withColumnRenamed("node", "print"), "print", "left")
        .select("cell", "print", F.pmod(F.xxhash64("print"), F.col("chunks")).alias("chunk"), F.coalesce("root", "print").alias("root"), "chunks")
    )
    members = materialise(members, "simhash-hot-members")
    classes = members.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = classes.groupBy("cell").agg(F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("strays")).where("strays > 0")
    open_ = materialise(open_, "simhash-open-cells")
    if open_.isEmpty():
        return first
    around = members.join(open_, "cell")
    packed = lambda print_, root: [F.collect_list("print").alias(print_), F.collect_list("root").alias(root)]
    of_strays = F.pmod(F.xxhash64("print", F.lit(1)), F.ceil(F.col("strays") / most)).alias("part")
    strays = around.where("root <> main").groupBy("cell", of_strays).agg(*packed("strays", "stray_roots"), F.first("chunks").alias("chunks"))
    strays = strays.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    chunks = around.groupBy("cell", "chunk").agg(*packed("members", "member_roots"))
    met = strays.join(chunks, ["cell", "chunk"]).select("strays", "stray_roots", "members", "member_roots")
    with arrow_batches(spark, 16):
        second = materialise(met.mapInArrow(_link_chunks(distance), "a long, b long"), "simhash-late-links")
    return first.unionByName(second)


def classified(docs: DataFrame, text: str = "text", distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """(doc_id, print, component_id) of every row."""
    small_batches(docs.sparkSession)
    printed = materialise(docs.select("doc_id", fingerprint(body(text)).alias("print")), "simhash-prints")
    distinct = materialise(printed.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    small_batches(docs.sparkSession)
    found = components(links(distinct.select("print"), distance, most))
    rooted = distinct.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = materialise(rooted, "simhash-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("print", "component_id")
    return printed.join(named, "print").select("doc_id", "print", "component_id")


def op13_popcount_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classified(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


travels_by_value(__name__)
