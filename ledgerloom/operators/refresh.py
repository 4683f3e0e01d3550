"""New state of a target table after a load; `sinks` writes it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators import ordered

# columns an existing invoice header takes over from the new load
LEDGER_UPDATE_COLUMNS = (
    "amount", "total", "discount", "remamount", "paytrm", "dlvby", "remark", "bilnum", "sale_area_code", "duedat", "so_number",
)


def replace_date_range(
    old: DataFrame, new: DataFrame, date_col: str, start: dt.date | None = None, end: dt.date | None = None, purge: str = "range"
) -> DataFrame:
    """'range': old rows outside [start, end] plus new; 'all': new only; 'none': both."""
    if purge == "all":
        return new.select(*old.columns)
    if purge == "range":
        if start is None or end is None:
            raise ValueError("purge='range' needs start and end")
        inside = F.col(date_col).between(F.lit(start), F.lit(end))
        old = old.where(F.col(date_col).isNull() | ~inside)
    elif purge != "none":
        raise ValueError(f"unknown purge mode {purge!r}")
    return old.unionByName(new.select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, key: str, update_cols: Sequence[str]) -> DataFrame:
    """New keys are inserted whole; known keys take only update_cols. Keys are unique on both sides."""
    incoming = new.select(F.col(key).alias("__key"), F.struct(*[F.col(c) for c in old.columns]).alias("__new"))
    both = old.withColumn("__old", F.lit(True)).join(incoming, F.col(key) == F.col("__key"), "full_outer")
    cols = []
    for c in old.columns:
        fresh = F.col("__new").getField(c)
        if c in update_cols:
            cols.append(F.when(F.col("__key").isNotNull(), fresh).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.when(F.col("__old"), F.col(c)).otherwise(fresh).alias(c))
    return both.select(*cols)


def ledger_upsert(old: DataFrame, new: DataFrame, key: str = "doc_number", update_cols: Sequence[str] = LEDGER_UPDATE_COLUMNS) -> DataFrame:
    return upsert(old, new, key, update_cols)


def insert_new_only(target: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows to append, one-row frame with the number of candidates, inserted and skipped)."""
    known = target.select(key).distinct()
    fresh = new.join(known, key, "left_anti").select(*new.columns)
    marked = new.join(known.withColumn("__known", F.lit(1)), key, "left")
    counts = marked.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count(F.when(F.col("__known").isNull(), 1)).alias("inserted"),
        F.count("__known").alias("skipped"),
    )
    return fresh, counts


def audit_columns(df: DataFrame, run_ts: dt.datetime, order: Sequence[str] | None = None, id_col: str = "id", blocks: int | None = None) -> DataFrame:
    """created_at and updated_at = run_ts; with an order also a 1-based id along it (numbered block by block)."""
    stamp = F.lit(run_ts.isoformat(" ")).cast("timestamp_ntz")
    out = df.withColumn("created_at", stamp).withColumn("updated_at", stamp)
    if not order:
        return out
    blocked = ordered.quantile_blocks(out, order, blocks)
    return ordered.row_numbers(blocked, [], order, id_col).drop(ordered.BLOCK)


def set_union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of left that right lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")
