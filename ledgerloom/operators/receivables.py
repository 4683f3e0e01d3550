"""Customer receivables and credit profile."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates, numbers
from ledgerloom.operators import filters
from ledgerloom.schemas import TOTAL

SALE_PREFIXES = ("IV", "CM", "OL")


def _or_zero(c: Column) -> Column:
    return F.coalesce(c.cast(TOTAL), F.lit(0).cast(TOTAL))


def _is_sale() -> Column:
    return filters.doc_prefix("docnum").isin(*SALE_PREFIXES)


def _sales_sum(run_date: dt.date, months: int) -> Column:
    since = dates.months_before(run_date, months)
    return F.sum(F.when(_is_sale() & (F.col("docdat") >= F.lit(since)), numbers.numeric_or_zero(F.col("netval"))))


def _average(total: Column, months: int) -> Column:
    """Always over the full number of months."""
    return F.round(total.cast("decimal(22,6)") / F.lit(months), 2)


def _remaining_sums(run_ts: dt.datetime) -> list[Column]:
    due = numbers.numeric_or_zero(F.col("remamt"))
    overdue = F.col("duedat").cast("timestamp_ntz") < F.lit(run_ts.isoformat(" ")).cast("timestamp_ntz")
    return [
        _or_zero(F.sum(F.when(_is_sale(), due))).alias("remaining_amt"),
        _or_zero(F.sum(F.when(_is_sale() & overdue, due))).alias("remaining_morethan_duedat"),
    ]


def _deposit_sum() -> Column:
    rest = numbers.numeric_or_zero(F.col("remamt"))
    return _or_zero(F.sum(F.when((filters.doc_prefix("docnum") == "AI") & (rest > 0), rest)))


def customer_avg_sales(docs: DataFrame, customers: DataFrame, run_date: dt.date, months: int = 6) -> DataFrame:
    """Average monthly sales of every customer over the last months; 0 without sales."""
    sums = docs.groupBy("cuscod").agg(_sales_sum(run_date, months).alias("__sum"))
    joined = customers.join(sums, "cuscod", "left")
    return joined.withColumn("avg_sales", _or_zero(_average(F.col("__sum"), months))).drop("__sum")


def customer_receivables(docs: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Open amount, and the part due before the run time (due on the run day counts)."""
    return docs.where(_is_sale() & F.col("cuscod").isNotNull()).groupBy("cuscod").agg(*_remaining_sums(run_ts))


def uncleared_cheques(bank: DataFrame) -> DataFrame:
    """Cheques QR... that were never paid in, summed per customer."""
    waiting = bank.where(F.col("chqnum").startswith("QR") & F.col("payindat").isNull() & F.col("cuscod").isNotNull())
    return waiting.groupBy("cuscod").agg(
        _or_zero(F.sum(numbers.numeric_or_zero(F.col("netamt")))).alias("chq_payindat_isnull")
    )


def unused_deposits(docs: DataFrame) -> DataFrame:
    open_ai = docs.where((filters.doc_prefix("docnum") == "AI") & (F.col("remamt") > 0) & F.col("cuscod").isNotNull())
    return open_ai.groupBy("cuscod").agg(_deposit_sum().alias("ai_notuse"))


def customer_credit_profile(
    customers: DataFrame, docs: DataFrame, bank: DataFrame, run_ts: dt.datetime, months: int = 6
) -> DataFrame:
    """Limit, term and the five measures of every customer; one pass over documents, one over cheques."""
    from_docs = docs.groupBy("cuscod").agg(
        _sales_sum(run_ts.date(), months).alias("__sum"),
        *_remaining_sums(run_ts),
        _deposit_sum().alias("ai_notuse"),
    )
    joined = customers.join(from_docs, "cuscod", "left").join(uncleared_cheques(bank), "cuscod", "left")
    return joined.select(
        F.col("cuscod").alias("customer_code"),
        F.col("cusnam").alias("customer_name"),
        _or_zero(_average(F.col("__sum"), months)).alias("avg_sales"),
        F.col("crline").alias("credit_limit"),
        "paytrm",
        *[
            _or_zero(F.col(c)).alias(c)
            for c in ("remaining_amt", "remaining_morethan_duedat", "chq_payindat_isnull", "ai_notuse")
        ],
    )
