"""Sharding by Karmarkar-Karp differencing: groups of equal texts go to shards of nearly equal bytes.

A partial partition is a tuple of `shards` sums. Differencing takes the two with the largest spread (largest minus smallest sum) and
adds them in opposite order, until one is left; going back through the merges gives each group its shard. Groups smaller than a BUNDLES-th of all
bytes first meet in BUNDLES bundles by hash, larger ones stay alone, so that one task differences at most 2 * BUNDLES
items whatever the input, and the items stay small against a shard: shards come out nearly equal unless one group alone is
larger than a shard's share (equal texts are never parted). Law: `bytes`.

Defined results: null text has size 1 and its group is that of the null texts, apart from the empty ones; repeated rows and equal
texts share a shard; a null doc_id gets a slot like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import body, number_within, read, travels_by_value
from ledgerloom.session import materialise

SHARDS = 8
BUNDLES = 20_000


def difference(sizes: list[int], ways: int) -> list[int]:
    """The way (0 to ways - 1) of each size."""
    sums = [[size] + [0] * (ways - 1) for size in sizes]
    heap = [(-size, k) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    merges = []  # (left, right) with the places that their sums took
    while len(heap) > 1:
        left, right = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        down = sorted(range(ways), key=lambda k: -sums[left][k])
        up = sorted(range(ways), key=lambda k: sums[right][k])
        merges.append((left, right, down, up))
        both = [sums[left][i] + sums[right][j] for i, j in zip(down, up, strict=True)]
        sums[left] = sums[right] = []
        heapq.heappush(heap, (min(both) - max(both), len(sums)))
        sums.append(both)
    where: list[list[int]] = [[]] * len(sums)
    where[-1:] = [list(range(ways))] * bool(sums)
    for k in range(len(merges) - 1, -1, -1):
        here = where[len(sizes) + k]
        for child, order in zip(merges[k][:2], merges[k][2:], strict=True):
            places = [0] * ways
            for place, own in enumerate(order):
                places[own] = here[place]
            where[child] = places
        where[len(sizes) + k] = []
    return [places[0] for places in where[: len(sizes)]]


def shard_groups(groups: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """(item, shard) for groups (item long, size long; a written table)."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    own = F.when(F.col("size") * bundles >= total, F.col("item")).otherwise(-1 - F.pmod(F.xxhash64("item"), F.lit(bundles)))
    bundled = groups.withColumn("bundle", own)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bundle")
        return pd.DataFrame({"bundle": rows["bundle"], "shard": difference([int(x) for x in rows["size"]], shards)})

    sums = bundled.groupBy("bundle").agg(F.sum("size").alias("size"))  # 2 * bundles rows at most
    placed = materialise(sums.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(one, "bundle long, shard int"), "shard-bundles")
    return bundled.join(placed, "bundle").select("item", "shard")


def shards_of(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each row of docs."""
    data = body().cast("binary")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        "doc_id",
        (F.octet_length(body()).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.sha2(data, 256).alias("digest"),
        F.col("text").isNull().alias("blank"),
    )
    rows = materialise(rows, "shard-rows")
    groups = rows.groupBy("digest", "blank").agg(F.min("row_id").alias("item"), F.sum("size").alias("size"))
    groups = materialise(groups, "shard-groups")
    placed = groups.select("digest", "blank", "item").join(shard_groups(groups, shards, bundles), "item").drop("item")
    out = materialise(rows.join(placed, ["digest", "blank"]).select("row_id", "doc_id", "size", "text_crc32", "shard"), "shard-placed")
    return number_within(out, ["shard"], ["row_id"], "slot").drop("row_id")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards_of(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


travels_by_value(__name__)
