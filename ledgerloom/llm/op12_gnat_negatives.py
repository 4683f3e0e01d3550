"""Hard negatives through a GNAT-style multiway hyperplane tree.

An anchor's positives are its highest-scoring other rows of the same label; its hard negatives are, for each positive, the highest-scoring rows of another
label whose score lies in a window below the positive's. Scores are integer inner products.

The tree: a node has up to FANOUT split points, and a row goes to the subtree of the nearest one (the first of equals). For every split point and
every sibling subtree the node stores the range of the distances between the point and the subtree's rows, and for every subtree the
range of its squared norms. As the squared distance is the sum of the squared norms less twice the score, a window of scores is an annulus of
distances around the anchor; by the triangle inequality a subtree is eliminated where, for any split point, its range and the annulus cannot meet. Leaves
are scanned exactly. Split points are chosen far from each other in a sample of at most SAMPLE rows, 16 for each leaf; the ranges and leaves hold all rows.

A search asks the anchor's own leaf first. What it finds there bounds the window from below (the score of the last result wanted), and the
second search visits all leaves that the narrowed window leaves alive. So positives and negatives are exact whatever the tree looks like.

In Spark, a leaf is a few blocks of at most about ROWS rows, packed as matrices, and neighbouring blocks form crews of a few; a batch of anchors goes once to
each crew with leaves it visits, and every meeting of a batch with a block is one row of a join. The driver holds the tree and the number of each leaf's blocks
alone: at most FANOUT ** DEPTH leaves. Rows of a leaf come to their block sorted, one block at a time. A packed block or batch is a row of up to a megabyte and
more, so their tables are written and read a few rows at a time.

Defined results: rows with a null vec_id, label or vector, or null or non-finite components take no part; shorter vectors count as filled up with zeros; rows
with the anchor's vec_id are never its positives or negatives; a repeated row is an anchor, a positive and a negative of its own; an anchor without
positives, or a positive without negatives in its window (such as one with a score below zero), gives no rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, few_at_once, read, travels_by_value
from ledgerloom.session import drop_tables, materialise, tracked

EVERY = 50
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score, in hundredths of the positive's
FANOUT = 8
DEPTH = 3
LEAF = 1_024  # rows wanted in a leaf
SAMPLE = 16 * FANOUT**DEPTH
ROWS = 8_192
ANCHORS = 512
CREW = 8  # blocks of a crew at most, where there are many
CREWS = 32  # crews at least, where there are as many blocks
MET = 4  # packed rows that a task holds at once
SHORT_PAGES = {"parquet.page.size.row.check.min": "1"}  # a page ends behind any row that fills it, not behind a hundred
_TILE = 256
_LEAST, _MOST = -(1 << 62), 1 << 62


def quantised(vectors: DataFrame, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """(vec_id, label, ints) of the rows that take part."""
    wide = F.transform(F.col(column), lambda x: x.cast("double"))
    whole = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    known = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(column).isNotNull())
    ints = F.transform(wide, lambda x: F.floor(x * scale).cast("bigint"))
    return known.where(whole).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), ints.alias("ints"))


def squares(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances as 64-bit integers."""
    return (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * _products(rows, points)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, in a float type that holds them exactly where there is one."""
    most = float(a.shape[1]) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most >= 1 << 53:
        return a @ b.T
    kind = np.float32 if most < 1 << 24 else np.float64
    return (a.astype(kind) @ b.T.astype(kind)).astype(np.int64)


@dataclass
class Node:
    points: np.ndarray
    children: list[int]  # a node's number, or -1 - the leaf's
    nearest: np.ndarray = field(default_factory=lambda: np.empty(0))  # [point, child]: the range of distances
    farthest: np.ndarray = field(default_factory=lambda: np.empty(0))
    norms: np.ndarray = field(default_factory=lambda: np.empty(0))  # [child]: least and greatest squared norm


@dataclass
class Tree:
    nodes: list[Node]
    leaves: int

    @staticmethod
    def fitted(sample: np.ndarray, depth: int, fanout: int = FANOUT) -> Tree:
        tree = Tree([], 0)
        if tree._grow(sample, depth, fanout) < 0:
            return Tree([], 1)
        return tree

    def _grow(self, sample: np.ndarray, depth: int, fanout: int) -> int:
        points = far_points(sample, fanout) if depth and len(sample) >= 2 * fanout else sample[:0]
        if len(points) < 2:
            self.leaves += 1
            return -self.leaves
        number = len(self.nodes)
        self.nodes.append(Node(points, []))
        child = squares(sample, points).argmin(axis=1)
        self.nodes[number].children = [self._grow(sample[child == c], depth - 1, fanout) for c in range(len(points))]
        return number

    def descend(self, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
        """The leaf of each row, and of every node met: (node, rows, squared distances to its points, child)."""
        leaf, met = np.zeros(len(rows), np.int32), []
        stack = [(0, np.arange(len(rows)))] if self.nodes else []
        while stack:
            number, at = stack.pop()
            node = self.nodes[number]
            distances = squares(rows[at], node.points)
            child = distances.argmin(axis=1)
            met.append((number, at, distances, child))
            for c, below in enumerate(node.children):
                mine = at[child == c]
                if below < 0:
                    leaf[mine] = -1 - below
                elif len(mine):
                    stack.append((below, mine))
        return leaf, met

    def alive(self, anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, anchors) where a row's score may lie in one of an anchor's windows (lows and highs: a row per anchor, a column per window)."""
        some = np.flatnonzero((lows <= highs).any(axis=1))
        if not self.nodes:
            yield 0, some
            return
        norms = (anchors * anchors).sum(axis=1).astype(np.float64)
        lows, highs = np.where(lows <= highs, lows, _MOST).astype(np.float64), np.where(lows <= highs, highs, _LEAST).astype(np.float64)
        stack = [(0, some)]
        while stack:
            number, at = stack.pop()
            node = self.nodes[number]
            far = np.sqrt(squares(anchors[at], node.points).astype(np.float64))[:, :, None]
            least = np.maximum(far - node.farthest, node.nearest - far).max(axis=1)[:, None, :]
            most = (far + node.farthest).min(axis=1)[:, None, :]
            outer = norms[at, None, None] + node.norms[:, 1] - 2 * lows[at][:, :, None]
            inner = norms[at, None, None] + node.norms[:, 0] - 2 * highs[at][:, :, None]
            slack = 1e-6 * (1 + most)  # distances are rounded
            held = (outer >= -slack) & (least <= np.sqrt(np.maximum(outer, 0)) + slack) & (most >= np.sqrt(np.maximum(inner, 0)) - slack)
            held = held.any(axis=1) & (node.norms[:, 0] <= node.norms[:, 1])
            for c, below in enumerate(node.children):
                mine = at[held[:, c]]
                if not len(mine):
                    continue
                if below < 0:
                    yield -1 - below, mine
                else:
                    stack.append((below, mine))


def far_points(sample: np.ndarray, many: int) -> np.ndarray:
    """Up to `many` different vectors, each the farthest from those before it, among the first of the sample."""
    some = sample[: 16 * many]
    chosen = [0] if len(some) else []
    nearest = squares(some, some[:1])[:, 0] if chosen else np.empty(0)
    while chosen and len(chosen) < many and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squares(some, some[chosen[-1]][None])[:, 0])
    return some[chosen]


def best(collected: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the k highest scores per anchor among the collected ones (a mask), ties to the smaller id."""
    if not collected.any() or not k:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if scores.shape[1] > k:
        held = np.where(collected, scores, _LEAST)
        collected = collected & (scores >= np.partition(held, -k, axis=1)[:, -k][:, None])
    a, r = np.nonzero(collected)
    order = np.lexsort((ids[r], -scores[a, r], a))
    a, r = a[order], r[order]
    kept = np.arange(len(a)) - np.searchsorted(a, a) < k
    return a[kept], r[kept]


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The matrix in the smallest type of two bytes or more that holds it."""
    least, most = int(matrix.min(initial=0)), int(matrix.max(initial=0))
    return matrix.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max))


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


@dataclass
class Index:
    """The tree, and its leaves as packed blocks: crew, leaf, part, ids, labels, kind and data."""

    tree: Tree
    width: int
    rows: DataFrame  # vec_id, label, ints, leaf
    blocks: DataFrame
    crews: dict[int, list[int]]  # the crews with blocks of each leaf

    @staticmethod
    def built(rows: DataFrame, fanout: int = FANOUT, depth: int = DEPTH, per_leaf: int = LEAF, per_block: int = ROWS) -> Index:
        """rows: (vec_id, label, ints)."""
        spark = rows.sparkSession
        with tracked() as whole:
            rows = materialise(rows, "gnat-rows")
        many, width = rows.agg(F.count(F.lit(1)), F.max(F.size("ints"))).first()
        width = max(width or 0, 1)
        short = F.size("ints") < width
        rows = rows.withColumn("ints", F.when(short, F.concat("ints", F.array_repeat(F.lit(0).cast("bigint"), width - F.size("ints")))).otherwise(F.col("ints")))
        levels = 0
        while levels < depth and many > per_leaf * fanout**levels:
            levels += 1
        # a bounded sample: the rows of the least digests
        drawn = rows.select("ints").orderBy(F.xxhash64("vec_id", "ints")).limit(16 * fanout**levels).collect() if levels else []
        tree = Tree.fitted(np.array([r["ints"] for r in drawn], np.int64).reshape(-1, width), levels, fanout)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf, _ = tree.descend(_lists(batch.column("ints"), width))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], [*batch.schema.names, "leaf"])

        def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[tuple[int, int, int], list[int]] = {}

            def widen(key: tuple[int, int, int], values: np.ndarray) -> None:
                low, high = kept.get(key, (_MOST, _LEAST))
                kept[key] = [min(low, int(values.min())), max(high, int(values.max()))]

            for batch in batches:
                vectors = _lists(batch.column("ints"), width)
                sums = (vectors * vectors).sum(axis=1)
                for number, at, distances, child in tree.descend(vectors)[1]:
                    for c in np.unique(child).tolist():
                        mine = child == c
                        widen((number, -1, c), sums[at[mine]])
                        for p in range(distances.shape[1]):
                            widen((number, p, c), distances[mine, p])
            if kept:
                columns = [*zip(*kept, strict=True), *zip(*kept.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "point", "child", "low", "high"])

        with arrow_batches(spark, 4_096):
            rows = materialise(rows.mapInArrow(placed, "vec_id long, label long, ints array<long>, leaf int"), "gnat-placed")
            if tree.nodes:
                partial = rows.select("ints").mapInArrow(ranged, "node long, point long, child long, low long, high long")
                found = partial.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
                tree = _with_ranges(tree, found)
        drop_tables(spark, whole)
        sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
        counted = sizes.select("leaf", F.ceil(F.col("n") / per_block).cast("int").alias("parts")).orderBy("leaf").collect()
        many = sum(r["parts"] for r in counted)
        of = max(-(-many // CREW), min(many, CREWS))
        firsts = np.cumsum([0, *(r["parts"] for r in counted)]).tolist()
        crews = {r["leaf"]: sorted({n * of // many for n in range(first, first + r["parts"])}) for r, first in zip(counted, firsts, strict=False)}
        parts = spark.createDataFrame([(r["leaf"], r["parts"], n) for r, n in zip(counted, firsts, strict=False)], "leaf int, parts int, ahead long")

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, []

            def block() -> pa.RecordBatch:
                ids, labels = (np.concatenate([h[i] for h in held]).tobytes() for i in (0, 1))
                matrix = _narrow(np.concatenate([h[2] for h in held]))
                return pa.RecordBatch.from_pydict({n: pa.array([x], pa.int32()) for n, x in zip(("crew", "leaf", "part"), key, strict=True)} | {"ids": [ids], "labels": [labels], "kind": [matrix.dtype.str], "data": [matrix.tobytes()]})

            for batch in batches:
                crew, leaf, part, ids, labels = (batch.column(c).to_numpy() for c in ("crew", "leaf", "part", "vec_id", "label"))
                matrix = _lists(batch.column("ints"), width)
                starts = [0, *(np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0)) + 1).tolist(), batch.num_rows]
                for at, end in zip(starts, starts[1:], strict=False):
                    if at < end:
                        if held and key != (crew[at], leaf[at], part[at]):
                            yield block()
                            held = []
                        key = crew[at], leaf[at], part[at]
                        held.append((ids[at:end].copy(), labels[at:end].copy(), _narrow(matrix[at:end])))
            if held:
                yield block()

        part = F.pmod(F.xxhash64("vec_id", "ints"), F.col("parts")).cast("int").alias("part")
        # a block: about per_block rows; equal rows share one
        numbered = rows.join(parts, "leaf").select("leaf", part, "ahead", "vec_id", "label", "ints")
        crew = F.call_function("div", (F.col("ahead") + F.col("part")) * of, F.lit(many)).cast("int").alias("crew")
        sorted_rows = numbered.select(crew, "leaf", "part", "vec_id", "label", "ints").repartition("leaf", "part").sortWithinPartitions("leaf", "part")
        with arrow_batches(spark, 4_096):
            blocks = materialise(sorted_rows.mapInArrow(packed, "crew int, leaf int, part int, ids binary, labels binary, kind string, data binary"), "gnat-blocks", **SHORT_PAGES)
        return Index(tree, width, rows, blocks, crews)

    def search(self, anchors: DataFrame, k: int, same_label: bool, own_leaf: bool) -> DataFrame:
        """(aid, window, vec_id, score): the k best rows in each of an anchor's windows, of its label or of the others.

        anchors: aid, vec_id, label, ints, leaf, and lows and highs, arrays of equal length for all anchors.
        """
        tree, width, crews, spark = self.tree, self.width, self.crews, anchors.sparkSession

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                aids, ids, labels, leaf = (batch.column(c).to_numpy() for c in ("aid", "vec_id", "label", "leaf"))
                vectors = _lists(batch.column("ints"), width)
                lows, highs = (_lists(batch.column(c), len(batch.column(c).flatten()) // batch.num_rows) for c in ("lows", "highs"))
                asked = [(x, np.flatnonzero(leaf == x)) for x in np.unique(leaf).tolist()] if own_leaf else tree.alive(vectors, lows, highs)
                visited: dict[int, list[tuple[int, np.ndarray]]] = {}
                for x, at in asked:
                    for crew in crews.get(x, ()) if len(at) else ():
                        visited.setdefault(crew, []).append((x, at))
                for crew, pairs in visited.items():
                    some = np.unique(np.concatenate([at for _, at in pairs]))
                    mine, there = _narrow(vectors[some]), np.zeros((len(pairs), len(some)), bool)
                    for i, (_, at) in enumerate(pairs):
                        there[i, np.searchsorted(some, at)] = True
                    parts = {"leaves": np.array([x for x, _ in pairs], np.int64), "there": there, "aids": aids[some], "ids": ids[some], "labels": labels[some], "vectors": mine, "lows": lows[some], "highs": highs[some]}
                    yield pa.RecordBatch.from_pydict({"crew": pa.array([crew], pa.int32()), "a_kind": [mine.dtype.str]} | {f"a_{n}": [np.ascontiguousarray(v).tobytes()] for n, v in parts.items()})

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    at = np.flatnonzero(np.frombuffer(row["a_leaves"], np.int64) == row["leaf"])
                    if not len(at):
                        continue
                    data = {n: np.frombuffer(row[f"a_{n}"], np.int64) for n in ("aids", "ids", "labels", "lows", "highs")}
                    data["vectors"] = np.frombuffer(row["a_vectors"], row["a_kind"])
                    many = len(data["aids"])
                    here = np.frombuffer(row["a_there"], bool).reshape(-1, many)[at[0]]
                    data = {n: v.reshape(many, -1)[here].astype(np.int64) for n, v in data.items()}
                    aids, own, asked_for, vectors, lows, highs = (data[n] for n in ("aids", "ids", "labels", "vectors", "lows", "highs"))
                    rows = np.frombuffer(row["data"], row["kind"]).reshape(-1, width).astype(np.int64)
                    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                    for i in range(0, len(aids), _TILE):
                        tile = slice(i, i + _TILE)
                        scores = _products(vectors[tile], rows)
                        fit = (asked_for[tile] == labels[None, :]) == same_label
                        fit &= own[tile] != ids[None, :]
                        for w in range(lows.shape[1]):
                            a, r = best(fit & (scores >= lows[tile, w, None]) & (scores <= highs[tile, w, None]), ids, scores, k)
                            if len(a):
                                yield pa.RecordBatch.from_pydict({"aid": aids[tile, 0][a], "window": pa.array(np.full(len(a), w, np.int32)), "vec_id": ids[r], "score": scores[a, r]})

        visits = "crew int, a_kind string, a_leaves binary, a_there binary, a_aids binary, a_ids binary, a_labels binary, a_vectors binary, a_lows binary, a_highs binary"
        with tracked() as passing:
            with arrow_batches(spark, ANCHORS):
                asked = materialise(anchors.select("aid", "vec_id", "label", "ints", "leaf", "lows", "highs").mapInArrow(visit, visits), "gnat-visits", **SHORT_PAGES)
        with arrow_batches(spark, MET), few_at_once(spark, MET):
            found = materialise(asked.join(self.blocks, "crew").mapInArrow(scan, "aid long, window int, vec_id long, score long"), "gnat-found")
        drop_tables(spark, passing)
        return found


def _with_ranges(tree: Tree, found: list) -> Tree:
    for node in tree.nodes:
        many = len(node.points)
        # a child without rows keeps an empty range
        node.nearest, node.farthest = np.full((many, many), np.inf), np.full((many, many), 0.0)
        node.norms = np.tile(np.array([np.inf, -np.inf]), (many, 1))
    for number, point, child, low, high in found:
        node = tree.nodes[number]
        if point < 0:
            node.norms[child] = low, high
        else:
            node.nearest[point, child], node.farthest[point, child] = np.sqrt(low), np.sqrt(high)
    return tree


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("aid", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _hundredths(score: Column, part: int, up: bool) -> Column:
    """part / 100 of the score, rounded to a whole number; integers only."""
    whole = score * (-part if up else part)
    floor = F.call_function("div", whole - F.pmod(whole, F.lit(100)), F.lit(100))
    return -floor if up else floor


def hard_negatives(anchors: DataFrame, index: Index, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); anchors: rows of index.rows."""
    anchors = materialise(anchors.withColumn("aid", F.monotonically_increasing_id()), "gnat-anchors")
    whole = {"lows": F.array(F.lit(_LEAST + 1)), "highs": F.array(F.lit(_MOST))}
    near = ranked(index.search(anchors.withColumns(whole), positives, True, True), positives).where(F.col("rank") == positives)
    told = anchors.join(near.select("aid", F.col("score").alias("last")), "aid", "left")
    told = told.withColumns({"lows": F.array(F.coalesce("last", F.lit(_LEAST + 1))), "highs": whole["highs"]}).drop("last")
    kept = materialise(ranked(index.search(told, positives, True, False), positives), "gnat-positives")
    by_anchor = kept.groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("rank", "score"))).alias("scores"))  # at most `positives` entries
    numbers = F.array(*[F.lit(i + 1) for i in range(positives)])
    asked = anchors.join(by_anchor, "aid").withColumns(
        {
            "lows": F.transform(numbers, lambda i: F.coalesce(_hundredths(F.try_element_at("scores", i), low, True), F.lit(1).cast("bigint"))),
            "highs": F.transform(numbers, lambda i: F.coalesce(_hundredths(F.try_element_at("scores", i), high, False), F.lit(0).cast("bigint"))),
        }
    )
    asked = materialise(asked.drop("scores"), "gnat-windows")
    near = ranked(index.search(asked, negatives, False, True), negatives).where(F.col("rank") == negatives)
    raised = near.groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("raised"))
    asked = asked.join(raised, "aid", "left").withColumn("lows", F.transform("lows", lambda x, i: F.coalesce(F.try_element_at("raised", i), x)))
    found = ranked(index.search(asked.drop("raised"), negatives, False, False), negatives)
    pairs = kept.select("aid", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = pairs.join(anchors.select("aid", F.col("vec_id").alias("anchor_id")), "aid")
    return found.join(named, ["aid", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(read(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    index = Index.built(rows)
    return hard_negatives(index.rows.where(F.col("vec_id") % EVERY == 0), index)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    CAST(list_inner_product(CAST(a.ints AS DOUBLE[]), CAST(b.ints AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

travels_by_value(__name__)
