"""Invoice and credit-note ledger."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import numbers, text
from ledgerloom.operators import filters, matching, ordered
from ledgerloom.schemas import MONEY, TOTAL

INVOICE_PREFIXES = ("IV", "OL", "CM")
CREDIT_PREFIXES = ("SC", "SR", "SL")


def ledger_documents(docs: DataFrame, start: dt.date, end: dt.date) -> tuple[DataFrame, DataFrame]:
    """(invoices with their discount, credit notes) of the date range."""
    cleaned = (
        docs.withColumn("docnum", text.strip(F.col("docnum")))
        .withColumn("sonum", F.nullif(text.strip(F.col("sonum")), F.lit("")))
        .withColumn("cuscod", text.strip(F.col("cuscod")))
        .withColumn("bilnum", text.blank_to_null(F.col("bilnum")))
        .withColumn("amount", numbers.numeric_or_zero(F.col("amount")))
        .withColumn("total", numbers.numeric_or_zero(F.col("total")))
    )
    in_range = filters.date_range_filter(cleaned, "docdat", start, end)
    invoices = filters.doc_prefix_filter(in_range, "docnum", INVOICE_PREFIXES).withColumn(
        "disc", numbers.document_discount(F.col("amount"), F.col("total"))
    )
    return invoices, filters.doc_prefix_filter(in_range, "docnum", CREDIT_PREFIXES)


def credit_semi_join(credits: DataFrame, invoices: DataFrame) -> DataFrame:
    """Credit notes whose order reference is the full number of a kept invoice."""
    numbers_kept = invoices.select(F.col("docnum").alias("sonum")).distinct()
    return credits.join(numbers_kept, "sonum", "left_semi").select(*credits.columns)


def after_prefix(col: str) -> Column:
    return F.expr(f"substring(`{col}`, 3)")


def credit_prefix_semi_join(credits: DataFrame, invoices: DataFrame) -> DataFrame:
    """Credit notes whose number after the prefix starts with some invoice's number after the prefix."""
    bare = invoices.select(after_prefix("docnum").alias("__number"))
    tagged = credits.withColumn("__credit", after_prefix("docnum"))
    return matching.starts_with_any(tagged, "__credit", bare, "__number").drop("__credit")


def base_number(col: str) -> Column:
    """Characters 3 to 9 of a document number."""
    return F.substring(F.col(col), 3, 7)


def detail_split(lines: DataFrame, invoice_docs: DataFrame, credit_docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    def of(docs: DataFrame) -> DataFrame:
        return lines.join(docs.select("docnum").distinct(), "docnum", "left_semi").select(*lines.columns)

    return of(invoice_docs), of(credit_docs)


def line_row_order(
    lines: DataFrame,
    keys: Sequence[str] = ("docnum", "stkcod"),
    order: Sequence[str] = ("seqnum", "line_no"),
    blocks: int | None = None,
    bounds_from: DataFrame | ordered.Bounds | None = None,
) -> DataFrame:
    """1-based counter per document and SKU along the sequence number."""
    blocked = ordered.quantile_blocks(lines, order, blocks, bounds_from)
    return ordered.row_numbers(blocked, keys, order, "row_order").drop(ordered.BLOCK)


def customer_enrich(docs: DataFrame, customers: DataFrame, code: str = "cuscod") -> DataFrame:
    """Customer name, group (= name) and payment term (0 where unknown)."""
    known = customers.select(
        F.col("cuscod").alias("__cuscod"), F.col("cusnam").alias("customer_name"), F.col("paytrm").alias("__paytrm")
    )
    joined = docs.drop("paytrm").join(known, F.col(code) == F.col("__cuscod"), "left")
    return (
        joined.withColumn("customer_group", F.col("customer_name"))
        .withColumn("paytrm", F.coalesce(F.col("__paytrm"), F.lit(0)).cast("int"))
        .drop("__cuscod", "__paytrm")
    )


def customer_group_rule(code: Column, name: Column, marker: str = "3", others: str = "อื่นๆ") -> Column:
    """Customers 3... are groups of their own, all else is one group."""
    return F.when(code.startswith(marker), name).otherwise(F.lit(others))


def cost_enrich(lines: DataFrame, products: DataFrame) -> DataFrame:
    costs = products.select(F.col("stkcod").alias("__stkcod"), F.col("unitpr").alias("__cost"))
    joined = lines.join(costs, F.col("stkcod") == F.col("__stkcod"), "left")
    return joined.withColumn("cost", F.coalesce(F.col("__cost"), F.lit(0)).cast(MONEY)).drop("__stkcod", "__cost")


def remark_consolidate(
    remarks: DataFrame, position: str = "line_no", blocks: int | None = None, part_chars: int = ordered.PART_CHARS
) -> DataFrame:
    """Per document: its remarks in sequence as one text and the sales-order number written in them.

    (docnum, part_no, remark, so_number). A remark text above part_chars goes on in further parts.
    The clean-up works on each remark by itself: the ' | ' between two remarks stops every pattern used.
    """
    rows = remarks.select(
        "docnum",
        F.coalesce(F.col("seqnum").try_cast("int"), F.lit(0)).alias("seqnum"),
        position,
        F.coalesce("remark", F.lit("")).alias("remark"),
    )
    order = ["seqnum", position]
    found = F.concat(
        F.transform(
            F.regexp_extract_all("remark", F.lit(r"(?U)//\s*(\d{6,})(?=$|\s|\))"), F.lit(1)),
            lambda t, at: F.struct(F.lit(True).alias("long"), t.alias("token"), at.alias("at")),
        ),
        # a short token of six digits or more is a long one too and never used; five digits bound the list
        F.transform(
            F.regexp_extract_all("remark", F.lit(r"(?U)//\s*(\d{1,5})\)"), F.lit(1)),
            lambda t, at: F.struct(F.lit(False).alias("long"), t.alias("token"), at.alias("at")),
        ),
    )
    seen = F.when(F.col("token").isNotNull(), F.struct(*order, "at"))
    first_seen = (
        rows.select("docnum", *order, F.explode_outer(found).alias("t"))
        .select("docnum", *order, "t.*")
        .groupBy("docnum", "long", F.when(~F.col("long"), F.col("token")).alias("short"))
        .agg(F.min_by("token", seen).alias("token"), F.min(seen).alias("seen"))
    )
    docs = first_seen.groupBy("docnum").agg(
        F.max(F.when(F.col("long"), F.col("token"))).alias("__long"),
        F.array_sort(F.collect_list(F.when(~F.col("long"), F.struct("seen", "token")))).getField("token").alias("__shorts"),
    )
    listed = F.array_join(F.transform("__shorts", lambda t: F.concat(F.lit("SO"), t)), ",")
    so_number = F.coalesce(F.concat(F.lit("SO"), F.col("__long")), F.nullif(listed, F.lit("")))
    clean = F.concat(F.lit(" "), F.col("remark"), F.lit(" "))
    clean = F.regexp_replace(clean, r"(?U)//\s*\d+\)?", "")
    clean = F.regexp_replace(clean, r"(?U)\s{2,}", " ")
    clean = F.regexp_replace(clean, r"(?U)\s*,\s*", ", ")
    pieces = rows.where("remark <> ''").select("docnum", *order, clean.alias("piece"))
    blocked = ordered.quantile_blocks(pieces, order, blocks, remarks.withColumn("seqnum", F.coalesce(F.col("seqnum").try_cast("int"), F.lit(0))))
    # white space at either end goes, but for the blank that a closing comma was given
    joined = ordered.ordered_text(
        blocked, ["docnum"], order, "piece", "|", "remark", part_chars, trim_ends=(r"(?U)^\s+", r"(?U)(?<!,)\s$")
    )
    texts = joined.withColumn("remark", F.nullif(F.col("remark"), F.lit("")))
    return (
        docs.join(texts, "docnum", "left")
        .select("docnum", F.coalesce("part_no", F.lit(0)).alias("part_no"), "remark", so_number.alias("so_number"))
    )


def remark_enrich(docs: DataFrame, remarks: DataFrame, whole: bool = False) -> DataFrame:
    """Remark (its first part), remark_parts (how many it has) and order number onto the header; `remarks` holds all parts.

    whole: the remark has all its parts, and there is no remark_parts.
    """
    so_number = F.max("so_number").alias("so_number")
    if whole:
        texts = ordered.whole_text(remarks, ["docnum"], "remark", "|", so_number)
    else:
        texts = ordered.first_part(remarks, ["docnum"], "remark", "remark_parts", so_number)
    texts = texts.withColumnRenamed("docnum", "__docnum")
    joined = docs.drop("remark", "remark_parts", "so_number").join(texts, F.col("docnum") == F.col("__docnum"), "left").drop("__docnum")
    return joined if whole else joined.withColumn("remark_parts", F.coalesce("remark_parts", F.lit(0)))


def credit_allocation(
    invoice_lines: DataFrame,
    credit_lines: DataFrame,
    key_cols: Sequence[str],
    price_col: str,
    order_cols: Sequence[str],
    qty_col: str = "trnqty",
    blocks: int | None = None,
    bounds_from: DataFrame | ordered.Bounds | None = None,
) -> DataFrame:
    """Deduct credited quantity from the invoice lines of the same key and unit price, in order.

    The loop over lines is an overlap of intervals: line i takes what part of [0, credited total) falls into
    [quantity before it, quantity up to it). Adds deducted, balance and matched price.
    """
    keys = [*key_cols, price_col]
    credited = credit_lines.groupBy(*keys).agg(
        F.sum(F.greatest(F.col(qty_col), F.lit(0).cast(MONEY))).cast("decimal(28,2)").alias("__credited")
    )
    blocked = ordered.quantile_blocks(invoice_lines, order_cols, blocks, bounds_from)
    wanted = F.greatest(F.col(qty_col), F.lit(0).cast(MONEY))
    running = ordered.running_total(blocked, keys, order_cols, {"__hi": wanted}, per_key=credited)
    low = F.col("__hi") - wanted
    zero = F.lit(0).cast("decimal(28,2)")
    deducted = F.greatest(zero, F.least(F.col("__hi"), F.coalesce("__credited", zero)) - low)
    return (
        running.withColumn("qty_sc_sr_deducted", deducted.cast(MONEY))
        .withColumn("qty_balance", (F.col(qty_col) - F.col("qty_sc_sr_deducted")).cast(MONEY))
        .withColumn("unit_price_from_sc_sr", F.when(F.col("qty_sc_sr_deducted") > 0, F.col(price_col)))
        .drop("__hi", "__credited", ordered.BLOCK)
    )


def invoice_cost_status(headers: DataFrame, lines: DataFrame, white_list: DataFrame) -> DataFrame:
    """cost_total and status of every header: 2 fully credited, 1 all remaining goods have a cost, else 0.

    Nulls in the white list are ignored (in SQL they would make NOT IN unknown).
    """
    known = white_list.where(F.col("stkcod").isNotNull()).select("stkcod").distinct().withColumn("__listed", F.lit(True))
    # one row per document and SKU is enough for the white-list join
    per_sku = lines.groupBy("doc_number", "stkcod").agg(
        F.sum(F.coalesce("cost", F.lit(0)) * F.coalesce("qty_balance", F.lit(0))).alias("__cost"),
        F.sum("qty_balance").alias("__balance"),
        F.max(F.when((F.col("cost") == 0) & (F.col("qty_balance") > 0), 1).otherwise(0)).alias("__open"),
    )
    per_doc = (
        per_sku.join(known, "stkcod", "left")
        .groupBy("doc_number")
        .agg(
            F.sum("__cost").cast(TOTAL).alias("cost_total"),
            F.sum("__balance").alias("__balance"),
            # an unknown SKU is never "not in" a list
            F.max(F.when(F.col("__listed").isNull() & F.col("stkcod").isNotNull(), F.col("__open")).otherwise(0)).alias("__open"),
        )
    )
    status = (
        F.when(F.col("cost_total").isNull(), 0)
        .when(F.coalesce("__balance", F.lit(0)) == 0, 2)
        .when(F.col("__open") == 0, 1)
        .otherwise(0)
    )
    joined = headers.drop("cost_total", "status").join(per_doc, "doc_number", "left")
    return joined.withColumn("status", status.cast("int")).drop("__balance", "__open")


def credit_total_by_base(credits: DataFrame, number: str = "doc_number", total: str = "total") -> DataFrame:
    return credits.groupBy(base_number(number).alias("base_number")).agg(F.sum(total).cast(TOTAL).alias("credit_total"))


def bill_due_date(
    headers: DataFrame, customers: DataFrame | None = None, term: str = "max", bills_from: DataFrame | None = None
) -> DataFrame:
    """Due date of all documents on a bill: latest document date plus the longest payment term.

    term='customer' takes today's payment term of the customer on the bill's first document instead.
    bills_from: the same documents before costly steps, to collect the bills from.
    """
    on_bill = filters.doc_prefix("doc_number").isin("IV", "CM", "OL")
    valid = F.col("bilnum").isNotNull() & ~F.col("bilnum").isin("", "~")
    bills = (headers if bills_from is None else bills_from).where(on_bill & valid).groupBy("bilnum").agg(
        F.max("doc_date").alias("__last"),
        F.max("paytrm").alias("__term"),
        F.min_by("customer_code", F.col("doc_number")).alias("__customer"),
    )
    if term == "customer":
        known = customers.select(F.col("cuscod").alias("__customer"), F.col("paytrm").alias("__current"))
        bills = bills.join(known, "__customer", "left").withColumn("__term", F.col("__current"))
    elif term != "max":
        raise ValueError(f"unknown term {term!r}")
    due = F.date_add("__last", F.coalesce("__term", F.lit(0)).cast("int"))
    dated = bills.select(F.col("bilnum").alias("__bill"), due.alias("__due"))
    # documents without a bill would all meet under one key
    billed = headers.where(on_bill & valid).join(dated, F.col("bilnum") == F.col("__bill"), "left")
    billed = billed.withColumn("duedat", F.coalesce("__due", "duedat")).select(*headers.columns)
    return billed.unionByName(headers.where(~F.coalesce(on_bill & valid, F.lit(False))))


def monthly_credit_counts(credits: DataFrame, date: str = "docdat") -> DataFrame:
    return credits.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(F.count(F.lit(1)).alias("documents"))


def credit_base(col: str) -> Column:
    """Credit number after the prefix, up to the first hyphen."""
    return F.split(after_prefix(col), "-").getItem(0)


def dealer_documents(docs: DataFrame, start: dt.date, end: dt.date) -> tuple[DataFrame, DataFrame]:
    """(invoices of customers 1/2/3, SR/SC credits) in the date range, numbers upper-cased."""
    cleaned = docs.withColumn("docnum", text.strip(F.upper("docnum"))).withColumn("cuscod", text.strip(F.col("cuscod")))
    in_range = filters.date_range_filter(cleaned, "docdat", start, end)
    invoices = in_range.where(F.col("docnum").startswith("IV") & F.substring("cuscod", 1, 1).isin("1", "2", "3"))
    return invoices, in_range.where(F.substring("docnum", 1, 2).isin("SR", "SC"))


def credit_suffix_match(invoices: DataFrame, credits: DataFrame) -> DataFrame:
    """One row per credit note of an invoice (IV001 <- SR001, SC001-1)."""
    left = invoices.select(F.col("docnum").alias("invoice_doc_number"), after_prefix("docnum").alias("__base"))
    right = credits.select(
        credit_base("docnum").alias("__base"),
        F.col("docnum").alias("credit_doc_number"),
        F.col("total").alias("credit_total"),
        F.col("docdat").alias("credit_date"),
    )
    return right.join(left, "__base").drop("__base")


def credit_reference_parts(
    credits: DataFrame, position: str = "line_no", blocks: int | None = None, part_chars: int = ordered.PART_CHARS
) -> DataFrame:
    """(base, part_no, refs): credit numbers per invoice base in file order, comma-separated."""
    keyed = credits.select(credit_base("docnum").alias("__base"), position, "docnum")
    blocked = ordered.quantile_blocks(keyed, [position], blocks)
    return ordered.ordered_text(blocked, ["__base"], [position], "docnum", ",", "refs", part_chars)


def invoice_credit_netting(
    invoices: DataFrame, credits: DataFrame, position: str = "line_no", blocks: int | None = None, part_chars: int = ordered.PART_CHARS, whole: bool = False
) -> DataFrame:
    """Invoices with their credit total, net total and credit numbers in file order.

    debit_note_refs is the first part of the numbers, debit_note_parts says how many there are; credit_references gives all.
    whole: debit_note_refs has all the numbers, and there is no debit_note_parts.
    """
    totals = credits.groupBy(credit_base("docnum").alias("__base")).agg(F.sum("total").cast(TOTAL).alias("__credited"))
    parts = credit_reference_parts(credits, position, blocks, part_chars).withColumnRenamed("refs", "debit_note_refs")
    if whole:
        refs = ordered.whole_text(parts, ["__base"], "debit_note_refs", ",")
    else:
        refs = ordered.first_part(parts, ["__base"], "debit_note_refs", "debit_note_parts")
    joined = invoices.withColumn("__base", after_prefix("docnum")).join(totals.join(refs, "__base"), "__base", "left")
    netted = (
        joined.withColumn("credit_total", F.coalesce("__credited", F.lit(0)).cast(TOTAL))
        .withColumn("net_total", (F.col("total") - F.col("credit_total")).cast(TOTAL))
        .drop("__base", "__credited")
    )
    return netted if whole else netted.withColumn("debit_note_parts", F.coalesce("debit_note_parts", F.lit(0)))


def credit_references(
    invoices: DataFrame, credits: DataFrame, position: str = "line_no", blocks: int | None = None, part_chars: int = ordered.PART_CHARS
) -> DataFrame:
    """(docnum, part_no, debit_note_refs): the credit numbers of each invoice in file order, in parts."""
    parts = credit_reference_parts(credits, position, blocks, part_chars).withColumnRenamed("refs", "debit_note_refs")
    keyed = invoices.select("docnum", after_prefix("docnum").alias("__base"))
    return keyed.join(parts, "__base").select("docnum", "part_no", "debit_note_refs")


def dedupe_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return ordered.first_per_key(df, [key], order)
