"""Exact top-k search by inner product with a three-phase uniform threshold.

The columns of the vectors are cut into SLICES; a node is one slice of one block of rows, and a row's score is the sum of its partial scores over
the slices. Phase 1 gathers, for each query, the nodes' lists of highest partial scores (from SEEDS row blocks: any list gives a safe cutoff) and
sums them up; the k-th best sum is the cutoff. Phase 2 sends every node the cutoff divided by the number of slices and
collects the entries that reach it: a row below that in all slices is below the cutoff. Phase 3 resolves the collected rows' full scores exactly, keeps
those at the cutoff or above, and the best k of them are the answer.

Queries and rows meet block by block; blocks are packed matrices, so a pair of blocks is one row of a join, in one task. Scores are computed
in a float type that holds the integers exactly, else in 64-bit integers.

Defined results: rows with a null vec_id, a null vector, or null or non-finite components take no part; an empty vector scores 0; shorter vectors
count as filled up with zeros; repeated rows are found and searched as rows of their own, but rows with the query's vec_id are never its answer; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, read, travels_by_value
from ledgerloom.session import materialise

K = 20
EVERY = 20
SCALE = 64
SLICES = 2
SEEDS = 2
ROWS = 16_384
QUERIES = 4_096
_TILE = 256
_LOW = -(1 << 62)


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, ints) of the rows that take part."""
    wide = F.transform(F.col(column), lambda x: x.cast("double"))
    whole = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull()).where(whole).select("vec_id", F.transform(wide, lambda x: F.floor(x * SCALE)).alias("ints"))


def packed(rows: DataFrame, many: int, per_block: int, width: int, label: str) -> tuple[DataFrame, int]:
    """One row per block of about per_block vectors: block, n, ids and values (little-endian 64-bit, row by row)."""
    blocks = max(-(-many // per_block), 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            block = batch.column("block").to_numpy()
            lists = batch.column("ints")
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            values = np.zeros((len(sizes), width), np.int64)
            values[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
            ids = batch.column("vec_id").to_numpy()
            for b in np.unique(block):
                mine = block == b
                top = held.setdefault(int(b), ([], []))
                top[0].append(ids[mine])
                top[1].append(values[mine].astype(np.int32) if np.abs(values).max(initial=0) < 1 << 31 else values[mine])
        for b, (ids, parts) in held.items():
            matrix = np.concatenate(parts)
            small = np.abs(matrix).max(initial=0) < 1 << 15
            matrix = matrix.astype(np.int16 if small else np.int64)
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([b], pa.int32()), "n": pa.array([len(matrix)], pa.int32()), "ids": [np.concatenate(ids).astype("<i8").tobytes()], "kind": [matrix.dtype.str], "data": [matrix.tobytes()]}
            )

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    with arrow_batches(rows.sparkSession, 4096):
        return materialise(dealt.mapInArrow(pack, "block int, n int, ids binary, kind string, data binary"), label), blocks


def _matrix(row: dict, width: int, side: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row[f"{side}_ids"], "<i8"), np.frombuffer(row[f"{side}_data"], row[f"{side}_kind"]).reshape(-1, width)


def _exact_type(queries: np.ndarray, rows: np.ndarray) -> type:
    most = float(queries.shape[1]) * float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _slices(width: int, slices: int) -> list[slice]:
    edges = [width * i // slices for i in range(slices + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def local_lists(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, slices: int) -> np.ndarray:
    """Phase 1 at one row block: the best k full scores among the rows on the slices' lists, for each query; _LOW where there are fewer."""
    kind, parts = _exact_type(queries, rows), _slices(queries.shape[1], slices)
    queries, rows = queries.astype(kind), rows.astype(kind)
    out = np.full((len(queries), k), _LOW, np.int64)
    for i in range(0, len(queries), _TILE):
        partial = [queries[i : i + _TILE, s] @ rows[:, s].T for s in parts]
        own = query_ids[i : i + _TILE, None] == ids[None, :]
        total = sum(partial)
        listed = np.zeros(total.shape, bool)
        for p in partial:
            p[own] = -np.inf if kind is not np.int64 else _LOW
            best = np.argpartition(p, max(p.shape[1] - k, 0), axis=1)[:, -k:]
            np.put_along_axis(listed, best, True, axis=1)
        listed &= ~own
        q, r = np.nonzero(listed)
        scores = total[q, r].astype(np.int64)
        order = np.lexsort((-scores, q))
        q, scores = q[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < k
        out[i + q[kept], place[kept]] = scores[kept]
    return out


def entries(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, cutoff: np.ndarray, k: int, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3 at one row block: (query, row, score) of rows that reach the uniform threshold in a slice and the cutoff in full, the best k of each query."""
    kind, parts = _exact_type(queries, rows), _slices(queries.shape[1], slices)
    queries, rows = queries.astype(kind), rows.astype(kind)
    found = []
    for i in range(0, len(queries), _TILE):
        share = (cutoff[i : i + _TILE].astype(np.float64) / slices)[:, None]
        # rounded down where the type is narrower: never above the share itself
        share = np.nextafter(share.astype(kind), kind(-np.inf)) if kind is not np.int64 else np.floor(share).astype(np.int64) - 1024
        total = queries[i : i + _TILE, parts[0]] @ rows[:, parts[0]].T
        reached = total >= share
        for s in parts[1:]:
            p = queries[i : i + _TILE, s] @ rows[:, s].T
            reached |= p >= share
            total += p
        at = np.flatnonzero(reached)
        q, r = np.divmod(at, len(rows))
        scores = total.ravel()[at].astype(np.int64)
        kept = (scores >= cutoff[i + q]) & (query_ids[i + q] != ids[r])
        q, r, scores = q[kept], r[kept], scores[kept]
        order = np.lexsort((ids[r], -scores, q))
        q, r, scores = q[order], r[order], scores[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        found.append((i + q[kept], r[kept], scores[kept]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def _met(queries: DataFrame, query_blocks: int, rows: DataFrame, row_blocks: int) -> DataFrame:
    """Each query block beside each row block, by the pair of their numbers."""
    left = queries.select([F.col(c).alias(f"q_{c}") for c in queries.columns]).withColumn("r_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    right = rows.select([F.col(c).alias(f"r_{c}") for c in rows.columns]).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    return left.join(right, ["q_block", "r_block"])


def top_k(queries: DataFrame, rows: DataFrame, k: int = K, slices: int = SLICES, seeds: int = SEEDS, per_query_block: int = QUERIES, per_row_block: int = ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest score for each query; both tables are (vec_id, ints)."""
    spark = rows.sparkSession
    rows = materialise(rows, "topk-rows")
    queries = materialise(queries, "topk-queries")
    n_rows, row_width = rows.agg(F.count(F.lit(1)), F.max(F.size("ints"))).first()
    n_queries, query_width = queries.agg(F.count(F.lit(1)), F.max(F.size("ints"))).first()
    width = max(row_width or 0, query_width or 0, 1)
    slices = min(slices, width)
    row_table, row_blocks = packed(rows, n_rows, per_row_block, width, "topk-row-blocks")
    query_table, query_blocks = packed(queries, n_queries, per_query_block, width, "topk-query-blocks")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lists = local_lists(*_matrix(row, width, "q"), *_matrix(row, width, "r"), k, slices)
                yield pa.RecordBatch.from_pydict({"block": pa.array([row["q_block"]], pa.int32()), "lists": [lists.astype("<i8").tobytes()]})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lists = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, k) for x in row["lists"]], axis=1)
                cutoff = np.sort(lists, axis=1)[:, -k]
                yield pa.RecordBatch.from_pydict({"block": pa.array([row["block"]], pa.int32()), "cutoff": [cutoff.tobytes()]})

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, matrix = _matrix(row, width, "q")
                ids, data = _matrix(row, width, "r")
                q, r, scores = entries(query_ids, matrix, ids, data, np.frombuffer(row["q_cutoff"], "<i8"), k, slices)
                yield pa.RecordBatch.from_pydict(
                    {"q_block": pa.array(np.full(len(q), row["q_block"], np.int32)), "q_place": pa.array(q.astype(np.int32)), "query_id": query_ids[q], "vec_id": ids[r], "score": scores}
                )

    with arrow_batches(spark, 2):
        lists = materialise(_met(query_table, query_blocks, row_table.where(F.col("block") < seeds), min(seeds, row_blocks)).mapInArrow(first, "block int, lists binary"), "topk-lists")
        gathered = lists.groupBy("block").agg(F.collect_list("lists").alias("lists"))  # `seeds` lists of a query block
        cutoffs = materialise(gathered.mapInArrow(merged, "block int, cutoff binary"), "topk-cutoffs")
        told = query_table.join(cutoffs, "block")
        schema = "q_block int, q_place int, query_id long, vec_id long, score long"
        collected = materialise(_met(told, query_blocks, row_table, row_blocks).mapInArrow(second, schema), "topk-entries")
    order = Window.partitionBy("q_block", "q_place").orderBy(F.desc("score"), "vec_id")
    return collected.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(read(spark, sf_dir, "embeddings"))
    return top_k(vectors.where(F.col("vec_id") % EVERY == 0), vectors)


SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS ints FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_inner_product(CAST(q.ints AS DOUBLE[]), CAST(v.ints AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

travels_by_value(__name__)
