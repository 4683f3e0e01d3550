"""Stock movements, receipts and product dashboards."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates, numbers
from ledgerloom.operators import filters
from ledgerloom.schemas import MONEY, TOTAL

# fixed values: document kinds of the stock card
ISSUE_PREFIXES = ("IV", "OL", "OU", "PD", "OC", "OW", "OO")
RECEIPT_PREFIXES = ("HI", "RI", "RR", "HP", "PI", "JI", "LL")
ADJUST_PREFIXES = ("JU", "TK")


def product_dimension(
    products: DataFrame,
    accounts: DataFrame,
    groups: DataFrame,
    units: DataFrame,
    flags: DataFrame,
    excluded: Sequence[str] = filters.NON_GOODS_GROUPS,
) -> DataFrame:
    """Products with category, group, unit and owner; groups that are no goods are left out.

    The code tables are keyed by their code; AQE broadcasts them while they measure small.
    """

    def named(table: DataFrame, code: str, text: str, key: str, out: str) -> DataFrame:
        return table.select(F.col(code).alias(key), F.col(text).alias(out))

    kept = filters.excluded_group_filter(groups, "typdes", excluded)
    return (
        products.join(named(kept, "typcod", "typdes", "stkgrp", "group"), "stkgrp")
        .join(named(accounts, "acccod", "accdes", "acccod", "category"), "acccod", "left")
        .join(named(units, "typcod", "typdes", "qucod", "unit"), "qucod", "left")
        .join(named(flags, "sku", "owner", "stkcod", "owner_emp_id"), "stkcod", "left")
        .select("stkcod", "stkdes", F.col("barcod").alias("barcode"), "category", "group", "unit", "owner_emp_id")
    )


def period_of(date: Column, run_date: dt.date) -> Column:
    this = run_date.year * 12 + run_date.month - 1
    return F.when(dates.month_key(date) == this, F.lit("this_month")).when(
        dates.month_key(date) == this - 1, F.lit("last_month")
    )


def movement_class(docnum: Column, date: Column, qty: Column, run_date: dt.date) -> tuple[Column, Column]:
    """(class, quantity) of a stock-card line; class is null for lines that count nowhere."""
    prefix = filters.doc_prefix(docnum)
    month = period_of(date, run_date)
    bought = F.lit("bought_in")
    adjust = prefix.isin(*ADJUST_PREFIXES)
    cls = (
        F.when(prefix.isin(*ISSUE_PREFIXES), month)
        .when(prefix.isin(*RECEIPT_PREFIXES), bought)
        .when(adjust & (qty > 0), bought)
        .when(adjust, month)
    )
    return cls, F.when(adjust, F.abs(qty)).otherwise(qty)


def movement_classify(moves: DataFrame, run_date: dt.date) -> DataFrame:
    """Counting lines with their class (this_month, last_month, bought_in) and quantity."""
    cls, qty = movement_class(F.col("docnum"), F.col("docdat"), F.col("trnqty"), run_date)
    return moves.withColumn("period", cls).withColumn("class_qty", qty.cast(MONEY)).where(F.col("period").isNotNull())


def _class_sums(cls: Column, qty: Column) -> list[Column]:
    zero = F.lit(0).cast(TOTAL)
    names = {
        "withdrawn_this_month": "this_month",
        "withdrawn_last_month": "last_month",
        "total_bought_in_qty": "bought_in",
    }
    return [F.coalesce(F.sum(F.when(cls == value, qty)).cast(TOTAL), zero).alias(out) for out, value in names.items()]


def movement_summary(classified: DataFrame, products: DataFrame) -> DataFrame:
    """Issued this and last month and bought in, per SKU in scope: aggregated first, then cut to the scope."""
    sums = classified.groupBy("stkcod").agg(*_class_sums(F.col("period"), F.col("class_qty")))
    return sums.join(products.select("stkcod").distinct(), "stkcod", "left_semi")


def _first_when(prefixes: Sequence[str], order: Column, docnum: str = "docnum", date: str = "docdat") -> Column:
    """Sort key that exists for dated documents of these kinds only."""
    return F.when(filters.doc_prefix(docnum).isin(*prefixes) & F.col(date).isNotNull(), order)


def _latest_issue_aggs(order: Sequence[str]) -> list[Column]:
    """Latest issue date and kind. Ties keep the first line: the latest date is found first, so the smallest
    position wins by sorting on the negated day number."""
    key = F.struct((-F.unix_date("docdat")).alias("day"), *[F.col(c) for c in order])
    pick = _first_when(ISSUE_PREFIXES, key)
    return [
        F.max(F.when(pick.isNotNull(), F.col("docdat"))).alias("latest_date_export"),
        F.min_by(filters.doc_prefix("docnum"), pick).alias("docnum_latest_export"),
    ]


def latest_issue(moves: DataFrame, order: Sequence[str] = ("line_no",)) -> DataFrame:
    issued = moves.where(filters.doc_prefix("docnum").isin(*ISSUE_PREFIXES) & F.col("docdat").isNotNull())
    return issued.groupBy("stkcod").agg(*_latest_issue_aggs(order))


def _earliest_receipt_agg(order: Sequence[str], extra: Sequence[str] = ()) -> Column:
    key = F.struct("docdat", *[F.col(c) for c in order])
    value = F.struct(
        F.col("docdat").alias("earliest_date_import"),
        filters.doc_prefix("docnum").alias("docnum"),
        *[F.col(c) for c in extra],
    )
    return F.min_by(value, _first_when(RECEIPT_PREFIXES, key)).alias("__first")


def earliest_receipt(moves: DataFrame, skus: DataFrame, order: Sequence[str] = ("file_no", "line_no")) -> DataFrame:
    """First receipt of every SKU over all files (first file wins ties); SKUs without one keep nulls."""
    received = moves.where(filters.doc_prefix("docnum").isin(*RECEIPT_PREFIXES) & F.col("docdat").isNotNull())
    first = received.groupBy(F.trim("stkcod").alias("stkcod")).agg(_earliest_receipt_agg(order, ["source_file"]))
    found = first.select("stkcod", "__first.*")
    return skus.select("stkcod").distinct().join(found, "stkcod", "left")


def receipt_date_fallback(receipts: DataFrame, master: DataFrame) -> DataFrame:
    """Earliest receipt date, else the last purchase date of the stock master."""
    purchase = master.select("stkcod", F.col("lpurdat").alias("__lpurdat"))
    joined = receipts.join(purchase, "stkcod", "left")
    return joined.withColumn("earliest_date_import", F.coalesce("earliest_date_import", "__lpurdat")).drop("__lpurdat")


def source_file_counts(receipts: DataFrame) -> DataFrame:
    return receipts.where(F.col("source_file").isNotNull()).groupBy("source_file").agg(F.count(F.lit(1)).alias("skus"))


def product_stock_header(
    products: DataFrame, master: DataFrame, moves: DataFrame, run_date: dt.date, order: Sequence[str] = ("line_no",)
) -> DataFrame:
    """The product dashboard: one row per product with balance, cost, movement sums and first/last dates.

    All movement measures come from one aggregation over the stock card (partial sums before the shuffle);
    only its one row per SKU is joined.
    """
    # kind, class and quantity are worked out once per line, not in every sum
    cls, qty = movement_class(F.col("docnum"), F.col("docdat"), F.col("trnqty"), run_date)
    lines = moves.select("stkcod", filters.doc_prefix("docnum").alias("docnum"), "docdat", "trnqty", *order)
    counted = lines.where(F.col("docnum").isin(*ISSUE_PREFIXES, *RECEIPT_PREFIXES, *ADJUST_PREFIXES)).select(
        "*", cls.alias("__class"), qty.alias("__qty")
    )
    measures = counted.groupBy("stkcod").agg(
        *_class_sums(F.col("__class"), F.col("__qty")), *_latest_issue_aggs(order), _earliest_receipt_agg(order)
    )
    balances = master.select(
        "stkcod",
        F.col("totbal").alias("remaining_amount"),
        F.col("unitpr").alias("cost"),
        F.col("totval").alias("residual_value"),
        "lpurdat",
    )
    zero_filled = [
        "remaining_amount", "cost", "residual_value", "withdrawn_last_month", "withdrawn_this_month", "total_bought_in_qty",
    ]
    joined = products.join(balances, "stkcod", "left").join(measures, "stkcod", "left")
    out = joined.withColumn("earliest_date_import", F.coalesce("__first.earliest_date_import", "lpurdat"))
    out = out.withColumn("docnum_earliest_import", F.col("__first.docnum"))
    for c in zero_filled:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast(TOTAL))
    return out.select(
        *products.columns, *zero_filled, "earliest_date_import", "docnum_earliest_import", "latest_date_export", "docnum_latest_export"
    )


def zero_price_sku(moves: DataFrame, master: DataFrame) -> DataFrame:
    """Lines of SKUs whose unit price in the stock master is 0."""
    free = master.where(F.coalesce("unitpr", F.lit(0)) == 0).select(F.trim("stkcod").alias("stkcod")).distinct()
    return moves.join(free, "stkcod", "left_semi").select(*moves.columns).withColumn("unitpr_stmas", F.lit(0).cast(MONEY))


def zero_price_sku_summary(moves: DataFrame, master: DataFrame) -> DataFrame:
    """Quantity and value per SKU of the lines without a price, for SKUs whose master price is 0."""
    per_sku = (
        moves.where(numbers.numeric_or_zero(F.col("unitpr")) == 0)
        .groupBy("stkcod")
        .agg(
            F.sum(numbers.numeric_or_zero(F.col("trnqty"))).cast(TOTAL).alias("trnqty"),
            F.sum("trnval").cast(TOTAL).alias("trnval"),
        )
    )
    prices = master.where(F.coalesce("unitpr", F.lit(0)) == 0).select(
        F.trim("stkcod").alias("stkcod"),
        F.coalesce("unitpr", F.lit(0)).cast(MONEY).alias("unitpr_stmas"),
        F.coalesce("lpurpr", F.lit(0)).cast(MONEY).alias("lpurpr"),
    )
    return per_sku.join(prices, "stkcod").select("stkcod", "trnqty", "unitpr_stmas", "lpurpr", "trnval")


def summary_outer_merge(withdrawn: DataFrame, bought_in: DataFrame) -> DataFrame:
    """Issued and received sums of the same SKU side by side, 0 where one is absent."""
    both = withdrawn.join(bought_in, "stkcod", "full_outer")
    cols = [c for c in both.columns if c != "stkcod"]
    return both.select("stkcod", *[F.coalesce(F.col(c), F.lit(0).cast(both.schema[c].dataType)).alias(c) for c in cols])


def stock_by_location(stock: DataFrame, product: DataFrame, unit: DataFrame, group: DataFrame, location: DataFrame) -> DataFrame:
    """Active stock per location with product, unit, category and location names, rounded to cents (half even)."""
    named = (
        product.join(unit.select(F.col("typcod").alias("qucod"), F.col("typdes").alias("qudes")), "qucod", "left")
        .join(group.select(F.col("typcod").alias("stkgrp"), F.col("typdes").alias("category")), "stkgrp", "left")
        .select("stkcod", "stkdes", "qucod", "qudes", "category")
    )
    places = location.where(F.trim("tabtyp") == "21").select(
        F.trim("typcod").alias("loccod"), F.col("typdes").alias("locdes")
    )
    active = filters.status_filter(stock).withColumn("stkcod", F.trim("stkcod")).withColumn("loccod", F.trim("loccod"))
    joined = active.join(named, "stkcod").join(places, "loccod", "left")
    rounded = {c: numbers.round_half_even(F.col(c)).cast(MONEY) for c in ("locbal", "unitpr", "locval")}
    blanks = {c: F.coalesce(F.col(c), F.lit("")) for c in ("stkdes", "qucod", "qudes", "category", "locdes")}
    return joined.withColumns({**rounded, **blanks}).select(
        "stkcod", "stkdes", "loccod", "locdes", "locbal", "qucod", "qudes", "unitpr", "locval", "category", "lmovdat"
    )


STOCK_ORDER = ("stkcod", "stkdes", "loccod", "locbal", "unitpr", "locval", "lmovdat")
