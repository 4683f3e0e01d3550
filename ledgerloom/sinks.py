"""Writers. Whole tables are replaced, months are replaced as partitions, reports become one folder per sheet."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions import text
from ledgerloom.operators import refresh
from ledgerloom.sources import files


def full_refresh_write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


MONTH = "doc_month"


def write_months(df: DataFrame, path: str, date_col: str) -> None:
    """Write by month (yyyymm); only the months present in df are replaced. A big month gets several files."""
    month = F.year(date_col) * 100 + F.month(date_col)
    (
        df.withColumn(MONTH, month)
        .hint("rebalance", MONTH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def _months(start: dt.date, end: dt.date) -> list[int]:
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [m // 12 * 100 + m % 12 + 1 for m in range(first, last + 1)]


JOURNAL = "_load.json"


def _journal(path: str) -> tuple[pafs.FileSystem, str]:
    system, inner = files.file_system(f"{path}/{JOURNAL}")
    return system, inner


def _note(path: str, entry: dict) -> None:
    """Write the journal whole or not at all: under another name first."""
    system, inner = _journal(path)
    with system.open_output_stream(f"{inner}.new") as out:
        out.write(json.dumps(entry).encode())
    system.move(f"{inner}.new", inner)


def unfinished(path: str) -> dict | None:
    """The journal of a load that has not put all its months into the table."""
    system, inner = _journal(path)
    if system.get_file_info(inner).type != pafs.FileType.File:
        return None
    with system.open_input_stream(inner) as source:
        return json.loads(source.read())


def resume(spark: SparkSession, path: str) -> bool:
    """Finish the load that a table's journal speaks of; False where there is none.

    The staged months are put in place again, those that were there already too: each replaces its month as a whole, so it makes
    no difference how far the load had come. Without a journal a load had not touched the table, and nothing is to be undone.
    """
    entry = unfinished(path)
    if entry is None:
        return False
    if entry["filled"]:
        write_months(spark.read.parquet(entry["staging"]), path, entry["date"])
    for month in entry["emptied"]:
        system, inner = files.file_system(f"{path}/{MONTH}={month}")
        if system.get_file_info(inner).type == pafs.FileType.Directory:
            system.delete_dir(inner)
    system, inner = _journal(path)
    system.delete_file(inner)
    return True


def _load_months(spark: SparkSession, path: str, state: DataFrame, date_col: str, months: Sequence[int], staging: str) -> None:
    """Put `state`, the whole new contents of `months` and of what other months its rows are in, into a table.

    The rows are staged, as a folder cannot be read while it is overwritten. The journal, written when they all are, is the point of no return: before
    it the table is as it was, behind it `resume` ends the load after a failure at any place.
    """
    state.write.mode("overwrite").parquet(staging)
    month = F.year(date_col) * 100 + F.month(date_col)
    filled = {row[0] for row in spark.read.parquet(staging).select(month).distinct().collect()}
    _note(path, {"staging": staging, "date": date_col, "filled": len(filled), "emptied": sorted(set(months) - filled)})
    resume(spark, path)


def replace_date_range_write(
    spark: SparkSession, path: str, new: DataFrame, date_col: str, start: dt.date, end: dt.date, staging: str
) -> None:
    """Replace the rows of [start, end] in a table written by write_months.

    Rows of `new` outside the range, or without a date, are added to theirs. Only the months of the range and of these rows
    are read and rewritten; a month left without rows is removed. A load that was broken off is finished first (see resume), `staging` is then
    a folder of its own.
    """
    resume(spark, path)
    months = _months(start, end)
    old = spark.read.parquet(path)
    month = F.year(date_col) * 100 + F.month(date_col)
    outside = F.col(date_col).isNull() | ~F.col(date_col).between(F.lit(start), F.lit(end))
    further = {row[0] for row in new.where(outside).select(month).distinct().collect()}
    touched = old.where(_in_months({*months, *further})).drop(MONTH)
    _load_months(spark, path, refresh.replace_date_range(touched, new, date_col, start, end), date_col, months, staging)


def _in_months(months: set[int | None]) -> Column:
    """Condition on the month column alone, so that other months' files are never listed."""
    known = F.col(MONTH).isin(*sorted(m for m in months if m is not None))
    return known | F.col(MONTH).isNull() if None in months else known


def ledger_upsert_write(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    date_col: str,
    staging: str,
    key: str = "doc_number",
    update_cols: Sequence[str] = refresh.LEDGER_UPDATE_COLUMNS,
) -> None:
    """Insert or update rows in a table written by write_months; keys are unique on both sides.

    A pass over the keys alone finds the months that hold loaded ones. These, and the months that new rows are inserted into, are read and
    rewritten; all others stay as they are. A known row keeps its date (it is not among the updated columns), and so its month.
    """
    if date_col in update_cols:
        raise ValueError("a row that changes its date would change its month")
    resume(spark, path)
    old = spark.read.parquet(path)
    keys = new.select(key).distinct()
    held = {row[0] for row in old.select(MONTH, key).join(keys, key, "left_semi").select(MONTH).distinct().collect()}
    month = F.year(date_col) * 100 + F.month(date_col)
    fresh = new.join(old.where(_in_months(held)).select(key), key, "left_anti")
    entered = {row[0] for row in fresh.select(month).distinct().collect()}
    touched = old.where(_in_months(held | entered)).drop(MONTH)
    state = refresh.upsert(touched, new.select(*touched.columns), key, update_cols)
    _load_months(spark, path, state, date_col, [m for m in held if m is not None], staging)


def report_export(sheets: dict[str, DataFrame], path: str, fmt: str = "csv") -> None:
    """One folder per sheet, columns in the given order, text free of control characters."""
    for name, df in sheets.items():
        cleaned = [
            text.control_char_strip(F.col(f"`{f.name}`"), keep_tab_newline=True).alias(f.name)
            if f.dataType.simpleString() == "string"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
        writer = df.select(*cleaned).write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True).option("quoteAll", True).option("escape", '"')
        writer.format(fmt).save(f"{path}/{name}")
