"""Near-duplicate documents by ProbMinHash.

A text is the multiset of its five-word shingles (lower case, words between white space); a shingle's weight is its count. Each
shingle sends arrivals of a Poisson process whose rate is its weight, every arrival to a random register; a register keeps the shingle of its first
arrival, and a shingle stops as soon as its next arrival is later than the latest register. Two texts agree in a register with the
probability Jaccard similarity of their weights. Registers are joined to BANDS bands of ROWS; texts that share a band are candidates and are
verified by the exact probability Jaccard of their shingles.

Equal texts (same words) are one node, so copies are never paired. In a bucket every node is first compared with the bucket's least
node. Buckets whose nodes are not all linked that way are looked at whole, in chunks: a task holds one or two chunks, finds the exact similarity of their
nodes by a matrix product over shared shingles and gives only links that join classes. No candidate is left out and no bucket has a cap. Classes
are the components of all links. With 24 bands of 6 a pair of similarity 0.8 is a candidate with probability 0.999, one of 0.9 with probability 1 - 1e-8.

Defined results: null texts and texts without words have no class but their own; texts of fewer than five words are one
shingle; repeated rows and equal texts share a class; the class id is the least doc_id of the class (null if none has one); an
empty table gives no rows; all columns of any names are passed on by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, body, forget_kept, read, small_batches, travels_by_value, whole_row
from ledgerloom.llm.components import components
from ledgerloom.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 6
CHUNK = 512
_COLUMNS = 4096
_SLICE_WORDS = 1 << 17  # handled together in a worker


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit value of each 64-bit value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(values: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, shingle, count) of the documents values[offsets[i] : offsets[i + 1]], by owner and shingle; a short document is one shingle."""
    values, counts = values.astype(np.uint64), np.diff(offsets)
    places = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), places)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(places) - places, places)
    start, end = offsets[:-1][owner] + at, offsets[1:][owner]
    padded = np.concatenate([values, np.zeros(size, np.uint64)])
    found = np.zeros(len(owner), np.uint64)
    for j in range(size):
        found = mixed(found * np.uint64(31) + np.where(start + j < end, padded[start + j], np.uint64(j)) + np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    starts = np.flatnonzero(first)
    return owner[starts], found[starts], np.diff(np.append(starts, len(owner)))


def registers(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, documents: int, size: int) -> np.ndarray:
    """(documents, size): the shingle of the first arrival in each register."""
    arrival = np.full(documents * size, np.inf)
    holder = np.zeros(documents * size, np.uint64)
    latest = np.full(documents, np.inf)
    time, turn = np.zeros(len(owner)), 0
    while len(owner):
        turn += 1
        chance = mixed(shingle + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log(((chance >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / weight
        early = time < latest[owner]
        owner, shingle, weight, time, chance = (x[early] for x in (owner, shingle, weight, time, chance))
        at = owner * size + (mixed(chance) % np.uint64(size)).astype(np.int64)
        np.minimum.at(arrival, at, time)
        won = arrival[at] == time
        holder[at[won]] = shingle[won]
        if turn < 4 or turn % 4 == 0:
            latest = arrival.reshape(documents, size).max(axis=1)
            going = time < latest[owner]
            owner, shingle, weight, time = (x[going] for x in (owner, shingle, weight, time))
    return holder.reshape(documents, size)


def _lists(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list array, null as empty."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(array), 0).to_numpy(zero_copy_only=False)
    return array.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _slices(*arrays: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """The arrays in slices of about _SLICE_WORDS words, one row at least."""
    sizes = sum(pa.compute.fill_null(pa.compute.list_value_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64) for a in arrays)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > _SLICE_WORDS:
            yield tuple(a.slice(start, i - start) for a in arrays)
            start, held = i, 0
        held += size
    yield tuple(a.slice(start) for a in arrays)


def band_keys(hashes: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """array<long>, one key per band; null for texts without words."""

    @F.arrow_udf("array<bigint>")
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget_kept()
        for batch in batches:
            parts = []
            for (part,) in _slices(batch):
                values, offsets = _lists(part)
                n = len(offsets) - 1
                owner, shingle, weight = shingles(values, offsets)
                # only documents that have words
                held = np.flatnonzero(np.diff(offsets) > 0)
                place = np.zeros(n, np.int64)
                place[held] = np.arange(len(held))
                won = registers(place[owner], shingle, weight, len(held), bands * rows).reshape(len(held), bands, rows)
                key = np.zeros((len(held), bands), np.uint64)
                for r in range(rows):
                    key = mixed(key * np.uint64(31) + won[:, :, r] + np.uint64(r + 1))
                sizes = np.where(np.diff(offsets) > 0, bands, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(key.ravel().view(np.int64)))
                parts.append(pa.compute.if_else(pa.array(sizes > 0), lists, pa.scalar(None, lists.type)))
            yield pa.concat_arrays(parts)

    return keys(hashes)


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two weight vectors over the same elements: the sum over common elements i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    pairs, many = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    x, y = pairs.astype(float)
    total = 0.0
    for i in np.flatnonzero((x > 0) & (y > 0)):
        total += many[i] / (many * np.maximum(x / x[i], y / y[i])).sum()
    return float(total)


def exact_similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard of two sets of shingles (sorted) with their counts."""
    if not len(a) or not len(b):
        return 0.0
    both = np.union1d(a, b)
    if len(x) == x.sum() and len(y) == y.sum():
        return (len(a) + len(b) - len(both)) / len(both)
    xs, ys = np.zeros(len(both), np.int64), np.zeros(len(both), np.int64)
    xs[np.searchsorted(both, a)] = x
    ys[np.searchsorted(both, b)] = y
    return probability_jaccard(xs, ys)


def similarity(left: Column, right: Column) -> Column:
    """Exact probability Jaccard of the shingles of two texts given as word hashes."""

    @F.arrow_udf("double")
    def exact(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lefts, rights in batches:
            out = []
            for part in _slices(lefts, rights):
                sides = [shingles(*_lists(side)) for side in part]
                n = len(part[0])
                ends = [np.searchsorted(owner, np.arange(n + 1)) for owner, _, _ in sides]
                for k in range(n):
                    (a, x), (b, y) = ((s[e[k] : e[k + 1]], c[e[k] : e[k + 1]]) for (_, s, c), e in zip(sides, ends, strict=True))
                    out.append(exact_similarity(a, x, b, y))
            yield pa.array(out, pa.float64())

    return exact(left, right)


def verified(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of similarity least or more; texts: (node, text)."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    return both.withColumn("similarity", similarity(word_hashes(F.col("left")), word_hashes(F.col("right")))).where(F.col("similarity") >= least).select("a", "b")


@dataclass
class _Member:
    node: int
    root: int
    chunk: int
    keys: list[int]
    shingles: np.ndarray
    counts: np.ndarray


def bucket_links(members: list[_Member], band: int, least: float) -> list[tuple[int, int]]:
    """Links that join the classes of a bucket's members as all links of similarity least or more between them would.

    members are one chunk of the bucket, or two that are held against each other. Looked at are pairs of different roots that share no earlier band. The part of
    each one's weight that lies on the other's shingles (one matrix product) is at least the similarity, and is the Jaccard
    similarity where all counts are one; only what passes is computed exactly, from the best on, and only while the two are not linked yet.
    """
    n = len(members)
    if n < 2:
        return []
    roots = np.array([m.root for m in members])
    chunks = np.array([m.chunk for m in members])
    keys = np.array([m.keys for m in members])
    open_ = np.triu(roots[:, None] != roots[None, :], 1)
    if len(set(chunks.tolist())) > 1:
        open_ &= chunks[:, None] != chunks[None, :]
    for k in range(band):
        open_ &= keys[:, k, None] != keys[None, :, k]
    if not open_.any():
        return []
    owner = np.repeat(np.arange(n), [len(m.shingles) for m in members])
    _, place, often = np.unique(np.concatenate([m.shingles for m in members]), return_inverse=True, return_counts=True)
    shared = often > 1
    number = np.cumsum(shared) - 1
    kept = shared[place]
    owner, column = owner[kept], number[place[kept]]
    totals = np.array([m.counts.sum() for m in members], np.float64)
    weight = np.concatenate([m.counts for m in members])[kept] / totals[owner]
    mass = np.zeros((n, n), np.float32)  # of i on the shingles of j
    order = np.argsort(column, kind="stable")
    owner, column, weight = owner[order], column[order], weight[order]
    for start in range(0, int(shared.sum()), _COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + _COLUMNS])
        part, held = np.zeros((n, _COLUMNS), np.float32), np.zeros((n, _COLUMNS), np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = weight[lo:hi]
        held[owner[lo:hi], column[lo:hi] - start] = 1
        mass += part @ held.T
    bound = np.minimum(mass, mass.T)
    left, right = np.nonzero(open_ & (bound >= least - 1e-3))
    best = np.argsort(-bound[left, right], kind="stable")
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    links = []
    for i, j in zip(left[best].tolist(), right[best].tolist(), strict=True):
        a, b = find(int(roots[i])), find(int(roots[j]))
        if a != b and exact_similarity(members[i].shingles, members[i].counts, members[j].shingles, members[j].counts) >= least:
            parent[max(a, b)] = min(a, b)
            links.append((min(members[i].node, members[j].node), max(members[i].node, members[j].node)))
    return links


def remaining_links(open_rows: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between members of different roots in the same bucket; open_rows: (band, key, node, root, n), nodes: (node, text, bands).

    A bucket is cut into chunks of about CHUNK members, and every two chunks meet in a group of their own.
    """
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    rows = open_rows.withColumn("chunk", F.pmod(F.xxhash64("node", "band"), chunks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    rows = rows.withColumn("other", other).select("band", "key", "node", "root", "chunk", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"))
    rows = rows.join(nodes, "node").repartition(*[F.col(c) for c in ("band", "key", "one", "two")]).sortWithinPartitions("band", "key", "one", "two", "node")
    rows = rows.select("band", "key", "one", "two", "node", "root", "chunk", "bands", word_hashes(F.col("text")).alias("words"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members = None, []

        def done() -> pa.RecordBatch:
            links = bucket_links(members, group[0], least) if group else []
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

        for batch in batches:
            at = [batch.column(c).to_pylist() for c in ("band", "key", "one", "two")]
            values = [batch.column(c).to_pylist() for c in ("node", "root", "chunk", "bands")]
            owner, found, counts = shingles(*_lists(batch.column("words")))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            for k in range(batch.num_rows):
                mine = tuple(x[k] for x in at)
                if mine != group:
                    yield done()
                    group, members = mine, []
                members.append(_Member(*(v[k] for v in values), found[ends[k] : ends[k + 1]].copy(), counts[ends[k] : ends[k + 1]].copy()))
        yield done()

    with arrow_batches(rows.sparkSession, 256):
        return materialise(rows.mapInArrow(linked, "a long, b long").distinct(), "dup-more")


def near_duplicates(rows: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """rows: a written table with row_id, doc_id and text. Gives (row_id, doc_id, node, class) and the links (a, b) that make the classes.

    A node is a distinct text (the least row_id that has it); node and class are null for texts without words.
    """
    small_batches(rows.sparkSession)
    signed = rows.select("row_id", "doc_id", F.md5(F.array_join(words(body()), " ")).alias("digest"), band_keys(word_hashes(body())).alias("bands"))
    signed = materialise(signed, "dup-signed")
    nodes = signed.where("bands is not null").groupBy("digest").agg(F.min("row_id").alias("node"))
    nodes = materialise(nodes.join(signed.select(F.col("row_id").alias("node"), "bands"), "node"), "dup-nodes")
    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    near = materialise(members.join(materialise(buckets, "dup-buckets"), ["band", "key"]), "dup-near")
    # every node of a bucket leads it or has a link to its leader, so these are all texts that are ever compared. No broadcast of
    # nodes: their number grows with the rows
    company = near.select("node").distinct().hint("merge")
    texts = materialise(rows.select(F.col("row_id").alias("node"), "text").join(company, "node"), "dup-texts")

    stars = materialise(near.where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), "dup-stars")
    links = materialise(verified(stars, texts, least), "dup-links")

    roots = materialise(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "dup-roots")
    placed = near.join(roots, "node", "left").select("band", "key", "node", F.coalesce("root", "node").alias("root"), "n")
    placed = materialise(placed, "dup-placed")
    open_ = placed.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("band", "key")
    open_rows = placed.join(open_, ["band", "key"])
    held = texts.join(nodes.select("node", "bands"), "node")
    links = links.unionByName(remaining_links(open_rows, held, least))
    classes_of = materialise(components(links), "dup-components")

    named = signed.select("row_id", "doc_id", F.when(F.col("bands").isNotNull(), F.col("digest")).alias("digest"))
    named = named.join(nodes.select("digest", "node"), "digest", "left").join(classes_of, "node", "left")
    return named.select("row_id", "doc_id", "node", F.coalesce("root", "node").alias("class")), links


def classes(rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id, the least doc_id of the class, for each row of rows (as in near_duplicates)."""
    placed = materialise(near_duplicates(rows, least)[0], "dup-classes")
    ids = placed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("__least"), F.count(F.lit(1)).alias("__n"))
    out = placed.join(ids, "class", "left")
    return out.select(
        "doc_id",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("__least")).alias("class_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("class_size"),
    )


def deduplicated(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """docs with one row of each class: the one with the least doc_id (then the first read). Rows without words stay."""
    rows = materialise(docs.select(whole_row(docs), F.monotonically_increasing_id().alias("row_id")), "dup-rows")
    placed = materialise(near_duplicates(rows.select("row_id", "doc.doc_id", "doc.text"), least)[0], "dup-classes")
    kept = placed.groupBy(F.coalesce("class", -1 - F.col("row_id")).alias("c")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")).alias("m"))
    kept = materialise(kept.select(F.col("m.row_id").alias("row_id")), "dup-kept")
    return rows.join(kept.hint("merge"), "row_id", "left_semi").select("doc.*")


def op6_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(materialise(docs.withColumn("row_id", F.monotonically_increasing_id()), "dup-rows"))


travels_by_value(__name__)
