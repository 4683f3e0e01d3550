"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import shuffle_width


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def body(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns of docs as one, so that working columns beside it cannot clash with them; "doc.*" gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """df with gapless numbers from 0 in every group of keys.

    A group is numbered in parts (parts follow a hash of the order columns, rows the order inside a part), so a
    group of any size takes many tasks; one count per (group, part) places the parts. Rows equal in all order
    columns get neighbouring numbers in any order. df is read twice: hand over a written table.
    """
    width = 4 * shuffle_width(df.sparkSession)
    parts = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(width)).cast("int"))
    counts = parts.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col("__part").alias("__p"),
        F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"),
    )
    inside = Window.partitionBy(*keys, "__part").orderBy(*order)
    rows = parts.withColumn("__i", F.row_number().over(inside) - 1)
    on = F.col("__part") == F.col("__p")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(counts, on).select(*df.columns, (F.col("__before") + F.col("__i")).cast("long").alias(name))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of so many rows at most: a batch of long texts has to fit beside the others in a worker.

    The setting is read when a plan runs, so it stays set in the session.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def ranges(df: DataFrame, column: str) -> tuple[Column, int]:
    """The number of a row's range, and how many there are: ranges of about equal row counts in the order of an integer column, null in the last.

    Only the bounds (one for each shuffle partition) come to the driver.
    """
    parts = shuffle_width(df.sparkSession)
    bounds = df.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0] or []
    bounds = sorted(set(bounds))
    fixed = F.lit(bounds) if bounds else F.array().cast("array<bigint>")

    def narrowed(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        above = F.get(fixed, middle) < F.col(column)
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(F.when(above, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(above, s["hi"]).otherwise(middle).alias("hi")))

    found = F.aggregate(F.sequence(F.lit(0), F.lit(len(bounds).bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), narrowed)["lo"]
    return F.when(F.col(column).isNull(), F.lit(len(bounds) + 1)).otherwise(found).cast("int"), len(bounds) + 2


@contextmanager
def few_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Written tables are read at most so many rows at once while a table is written from them: Spark reads 4,096 else, whatever their length."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows while a table is written."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def travels_by_value(module: str) -> None:
    """The module's functions reach the workers with their code, so nothing has to be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def kept_in_worker(key: Any, make: Callable[[], Any]) -> Any:
    """make() once per worker process; code that travels by value has no globals that outlive a task."""
    store = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")).__dict__.setdefault("store", {})
    if key not in store:
        store[key] = make()
    return store[key]


def forget_kept() -> None:
    """Free what earlier work has kept in this worker process."""
    sys.modules.get("_kept_in_worker", types.ModuleType("_")).__dict__.pop("store", None)


travels_by_value(__name__)
