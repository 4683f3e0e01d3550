"""Cash ledger from payables, receivables and bank transactions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.functions import dates, numbers, text
from ledgerloom.schemas import BANK_MASTER, CASH_LEDGER, conform

PAYABLE_PREFIXES = ("HI", "HP", "PS", "PN")
RECEIPT_PREFIXES = ("RE", "RC", "RD", "RM", "AI", "AC")


def _starts(col: str, prefixes: Sequence[str]) -> Column:
    return F.substring(F.col(col), 1, 2).isin(*prefixes)


def stripped(df: DataFrame) -> DataFrame:
    """Every text column trimmed, '' as null."""
    return df.select(
        *[
            F.nullif(text.strip(F.col(f.name)), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def bank_ledger_merge(docs: DataFrame, bank: DataFrame) -> DataFrame:
    """Documents with their bank transactions (voucher = number); documents without a bank account drop out."""
    booked = bank.where(F.col("bnkacc").isNotNull()).select(
        F.col("voucher").alias("docnum"),
        "chqnum", "trndat", "bnkacc", "payindat", F.col("netamt").alias("net_amt"), "chqdat", "remark", "cmplapp",
    )
    return booked.join(docs, "docnum")


def ledger_side(docs: DataFrame, bank: DataFrame, prefixes: Sequence[str], direction: str, start: dt.date, rule: str = "transaction") -> DataFrame:
    """One side (in or out) of the ledger: prefix and date filter, bank rows, cleaned cheque number, date."""
    kept = docs.where(_starts("docnum", prefixes) & (F.col("docdat") >= F.lit(start)))
    kept = kept.select(*[c for c in ("docnum", "docdat", "cuscod", "supcod") if c in kept.columns], F.lit(direction).alias("type"))
    merged = bank_ledger_merge(kept, bank)
    dated = merged.withColumn("chqnum", text.cheque_number_clean(F.col("chqnum"))).withColumn(
        "date", dates.payment_date_rule(F.col("trndat"), F.col("payindat"), F.col("docdat"), rule)
    )
    return stripped(conform(dated, CASH_LEDGER))


def bt_customer_backfill(transfers: DataFrame, receipts: DataFrame) -> DataFrame:
    """Customer of a transfer from the receipt of the same number, where it has none."""
    known = receipts.where("cuscod IS NOT NULL").groupBy("docnum").agg(F.max("cuscod").alias("__cuscod"))
    joined = transfers.join(known, "docnum", "left")
    return joined.withColumn("cuscod", F.coalesce("cuscod", "__cuscod")).drop("__cuscod")


def transfers(bank: DataFrame, receipts: DataFrame, start: dt.date) -> DataFrame:
    """Bank transfers (cheque number BT...) as ledger rows of their own."""
    kept = bank.where(F.col("chqnum").startswith("BT") & (F.col("trndat") >= F.lit(start)))
    flow = numbers.bank_flow_type(F.col("bktrntyp"))
    rows = (
        kept.withColumn("docnum", F.col("chqnum"))
        .withColumn("type", flow)
        .withColumn("date", F.when(F.col("type") == "in", F.col("chqdat")).otherwise(F.col("trndat")))
        .withColumnRenamed("netamt", "net_amt")
    )
    return stripped(conform(bt_customer_backfill(rows, receipts), CASH_LEDGER))


def cash_ledger(ap: DataFrame, ar: DataFrame, bank: DataFrame, start: dt.date) -> DataFrame:
    """Payables (out), receipts (in) and transfers, each with its bank account."""
    paid = ledger_side(ap, bank, PAYABLE_PREFIXES, "out", start)
    received = ledger_side(ar, bank, RECEIPT_PREFIXES, "in", start)
    rows = paid.unionByName(received).unionByName(transfers(bank, received, start))
    return rows.where(F.col("bnkacc").isNotNull())


def bank_accounts(master: DataFrame) -> DataFrame:
    return stripped(conform(master, BANK_MASTER))


def filtered_dump(df: DataFrame, number: str | None, prefixes: Sequence[str], date: str | None, start: dt.date | None) -> DataFrame:
    """Extract by document kind and first date, text free of control characters."""
    out = df
    if number:
        out = out.where(_starts(number, prefixes))
    if date:
        out = out.where(F.col(date) >= F.lit(start))
    cleaned = [
        text.control_char_strip(F.col(f.name), keep_tab_newline=True).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in out.schema.fields
    ]
    return out.select(*cleaned)
