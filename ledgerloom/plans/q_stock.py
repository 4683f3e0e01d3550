"""Stock queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import filters, matching, stock
from ledgerloom.plans import adapters as ad
from ledgerloom.plans import sqlparts as q
from ledgerloom.plans.registry import query
from ledgerloom.schemas import MONEY, TOTAL

_ISSUES = "('IV','OL','OU','PD','OC','OW','OO')"
_RECEIPTS = "('HI','RI','RR','HP','PI','JI','LL')"
_FIRST_ISSUE = f"""issue AS (SELECT stkcod, docdat AS latest_date_export, left(docnum, 2) AS docnum_latest_export FROM (
  SELECT *, row_number() OVER (PARTITION BY stkcod ORDER BY docdat DESC, {q.LINE_ORDER}) AS rn
  FROM moves WHERE left(docnum, 2) IN {_ISSUES}) WHERE rn = 1)"""
_FIRST_RECEIPT = f"""receipt AS (SELECT stkcod, docdat AS earliest_date_import, left(docnum, 2) AS docnum, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY stkcod ORDER BY docdat, file_no, {q.LINE_ORDER}) AS rn
  FROM moves WHERE left(docnum, 2) IN {_RECEIPTS}) WHERE rn = 1)"""
_SUMS = f"""
  CAST(coalesce(sum(class_qty) FILTER (period = 'this_month'), 0) AS {q.T}) AS withdrawn_this_month,
  CAST(coalesce(sum(class_qty) FILTER (period = 'last_month'), 0) AS {q.T}) AS withdrawn_last_month,
  CAST(coalesce(sum(class_qty) FILTER (period = 'bought_in'), 0) AS {q.T}) AS total_bought_in_qty"""


def dimension(spark, sf):
    return stock.product_dimension(
        ad.products(spark, sf), ad.accounts(spark, sf), ad.groups(spark, sf), ad.units(spark, sf), ad.flags(spark, sf), ad.GOODS_EXCLUDED
    )


@query("product_dimension", f"WITH {q.DIMENSION} SELECT * FROM dimension")
def product_dimension(spark, sf):
    return dimension(spark, sf)


@query(
    "movement_classify",
    f"WITH {q.CLASSED} SELECT docnum, docdat, stkcod, trnqty, period, class_qty FROM classed WHERE period IS NOT NULL",
)
def movement_classify(spark, sf):
    out = stock.movement_classify(ad.moves(spark, sf), ad.RUN_DATE)
    return out.select("docnum", "docdat", "stkcod", "trnqty", "period", "class_qty")


@query(
    "movement_summary",
    f"""WITH {q.CLASSED}, {q.DIMENSION} SELECT stkcod, {_SUMS} FROM classed
    WHERE period IS NOT NULL AND stkcod IN (SELECT stkcod FROM dimension) GROUP BY stkcod""",
)
def movement_summary(spark, sf):
    return stock.movement_summary(stock.movement_classify(ad.moves(spark, sf), ad.RUN_DATE), dimension(spark, sf))


@query("latest_issue", f"WITH {q.MOVES}, {_FIRST_ISSUE} SELECT * FROM issue")
def latest_issue(spark, sf):
    return stock.latest_issue(ad.moves(spark, sf), ad.LINE_ORDER)


def _receipts(spark, sf):
    return stock.earliest_receipt(ad.moves(spark, sf), ad.products(spark, sf), ("file_no", *ad.LINE_ORDER))


@query(
    "earliest_receipt",
    f"WITH {q.MOVES}, {q.PRODUCTS}, {_FIRST_RECEIPT} SELECT p.stkcod, r.* EXCLUDE (stkcod) FROM products p LEFT JOIN receipt r USING (stkcod)",
)
def earliest_receipt(spark, sf):
    return _receipts(spark, sf)


@query(
    "receipt_date_fallback",
    f"""WITH {q.MOVES}, {q.PRODUCTS}, {q.MASTER}, {_FIRST_RECEIPT}
    SELECT p.stkcod, coalesce(r.earliest_date_import, m.lpurdat) AS earliest_date_import, r.docnum, r.source_file
    FROM products p LEFT JOIN receipt r USING (stkcod) LEFT JOIN master m USING (stkcod)""",
)
def receipt_date_fallback(spark, sf):
    return stock.receipt_date_fallback(_receipts(spark, sf), ad.stock_master(spark, sf))


@query(
    "source_file_counts",
    f"""WITH {q.MOVES}, {q.PRODUCTS}, {_FIRST_RECEIPT}
    SELECT source_file, count(*) AS skus FROM products JOIN receipt USING (stkcod) GROUP BY source_file""",
)
def source_file_counts(spark, sf):
    return stock.source_file_counts(_receipts(spark, sf))


@query(
    "product_stock_header",
    f"""WITH {q.CLASSED}, {q.DIMENSION}, {q.MASTER}, {_FIRST_ISSUE},
    receipt AS (SELECT stkcod, docdat AS earliest_date_import, left(docnum, 2) AS docnum FROM (
      SELECT *, row_number() OVER (PARTITION BY stkcod ORDER BY docdat, {q.LINE_ORDER}) AS rn FROM moves WHERE left(docnum, 2) IN {_RECEIPTS}) WHERE rn = 1),
    sums AS (SELECT stkcod, {_SUMS} FROM classed GROUP BY stkcod)
    SELECT d.*, CAST(coalesce(m.totbal, 0) AS {q.T}) AS remaining_amount, CAST(coalesce(m.unitpr, 0) AS {q.T}) AS cost,
      CAST(coalesce(m.totval, 0) AS {q.T}) AS residual_value,
      CAST(coalesce(s.withdrawn_last_month, 0) AS {q.T}) AS withdrawn_last_month,
      CAST(coalesce(s.withdrawn_this_month, 0) AS {q.T}) AS withdrawn_this_month,
      CAST(coalesce(s.total_bought_in_qty, 0) AS {q.T}) AS total_bought_in_qty,
      coalesce(r.earliest_date_import, m.lpurdat) AS earliest_date_import, r.docnum AS docnum_earliest_import,
      i.latest_date_export, i.docnum_latest_export
    FROM dimension d LEFT JOIN master m USING (stkcod) LEFT JOIN sums s USING (stkcod)
    LEFT JOIN receipt r USING (stkcod) LEFT JOIN issue i USING (stkcod)""",
)
def product_stock_header(spark, sf):
    return stock.product_stock_header(
        dimension(spark, sf), ad.stock_master(spark, sf), ad.moves(spark, sf), ad.RUN_DATE, ad.LINE_ORDER
    )


_LL = "left(docnum, 2) = 'LL' AND posopr = '1' AND docdat BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"


def _ll_moves(spark, sf):
    return filters.operation_filter(ad.moves(spark, sf), "LL", dt.date(1996, 1, 1), dt.date(2000, 12, 31))


@query("operation_filter", f"WITH {q.MOVES} SELECT docnum, docdat, stkcod, trnqty, unitpr, trnval FROM moves WHERE {_LL}")
def operation_filter(spark, sf):
    return _ll_moves(spark, sf).select("docnum", "docdat", "stkcod", "trnqty", "unitpr", "trnval")


@query(
    "zero_price_sku",
    f"""WITH {q.MOVES}, {q.MASTER} SELECT docnum, docdat, stkcod, trnqty, unitpr, trnval, CAST(0 AS {q.M}) AS unitpr_stmas
    FROM moves WHERE {_LL} AND stkcod IN (SELECT stkcod FROM master WHERE unitpr = 0)""",
)
def zero_price_sku(spark, sf):
    out = stock.zero_price_sku(_ll_moves(spark, sf), ad.stock_master(spark, sf))
    return out.select("docnum", "docdat", "stkcod", "trnqty", "unitpr", "trnval", "unitpr_stmas")


@query(
    "zero_price_sku_summary",
    f"""WITH {q.MOVES}, {q.MASTER} SELECT v.stkcod, CAST(sum(v.trnqty) AS {q.T}) AS trnqty, any_value(m.unitpr) AS unitpr_stmas,
    any_value(m.lpurpr) AS lpurpr, CAST(sum(v.trnval) AS {q.T}) AS trnval
    FROM moves v JOIN master m USING (stkcod) WHERE {_LL} AND m.unitpr = 0 AND v.unitpr = 0 GROUP BY v.stkcod""",
)
def zero_price_sku_summary(spark, sf):
    return stock.zero_price_sku_summary(_ll_moves(spark, sf), ad.stock_master(spark, sf))


@query(
    "summary_outer_merge",
    f"""WITH {q.CLASSED},
    w AS (SELECT stkcod, CAST(sum(class_qty) AS {q.T}) AS withdrawn FROM classed WHERE period = 'this_month' GROUP BY 1),
    b AS (SELECT stkcod, CAST(sum(class_qty) AS {q.T}) AS bought_in FROM classed WHERE period = 'bought_in' GROUP BY 1)
    SELECT coalesce(w.stkcod, b.stkcod) AS stkcod, coalesce(withdrawn, 0) AS withdrawn, coalesce(bought_in, 0) AS bought_in
    FROM w FULL JOIN b ON w.stkcod = b.stkcod""",
)
def summary_outer_merge(spark, sf):
    classed = stock.movement_classify(ad.moves(spark, sf), ad.RUN_DATE)

    def total(period, out):
        return classed.where(F.col("period") == period).groupBy("stkcod").agg(F.sum("class_qty").cast(TOTAL).alias(out))

    return stock.summary_outer_merge(total("this_month", "withdrawn"), total("bought_in", "bought_in"))


@query(
    "key_anti_fill",
    f"""WITH {q.CLASSED}, {q.MASTER}, kept AS (SELECT stkcod, class_qty AS trnqty, period FROM classed WHERE period IN ('this_month', 'last_month'))
    SELECT * FROM kept UNION ALL
    SELECT stkcod, CAST(0 AS {q.M}), NULL FROM master WHERE stkcod NOT IN (SELECT stkcod FROM kept)""",
)
def key_anti_fill(spark, sf):
    classed = stock.movement_classify(ad.moves(spark, sf), ad.RUN_DATE).where("period <> 'bought_in'")
    lines = classed.select("stkcod", F.col("class_qty").alias("trnqty"), "period")
    return matching.key_anti_fill(lines, ad.stock_master(spark, sf), "stkcod", {"trnqty": F.lit(0).cast(MONEY)})


@query(
    "scope_mask",
    f"""WITH {q.MASTER}, {q.DIMENSION} SELECT stkcod,
    CASE WHEN stkcod IN (SELECT stkcod FROM dimension) THEN totbal ELSE 0 END AS totbal,
    CASE WHEN stkcod IN (SELECT stkcod FROM dimension) THEN totval ELSE 0 END AS totval FROM master""",
)
def scope_mask(spark, sf):
    master = ad.stock_master(spark, sf).select("stkcod", "totbal", "totval")
    return matching.scope_mask(master, "stkcod", dimension(spark, sf).select("stkcod"), ["totbal", "totval"])


_STLOC = f"""stloc AS (
  SELECT ' ' || 'SKU-' || CAST(l_partkey AS VARCHAR) AS stkcod, lpad(CAST(l_suppkey % 30 AS VARCHAR), 2, '0') AS loccod,
    CAST(l_quantity AS {q.M}) AS locbal, CAST(round(l_extendedprice * 100) AS BIGINT) * 5 AS mills,
    CAST(l_extendedprice AS {q.M}) AS locval, CAST(l_shipdate AS DATE) AS lmovdat, l_returnflag AS status FROM lineitem)"""


@query(
    "stock_by_location",
    f"""WITH {q.PRODUCTS}, {_STLOC}
    SELECT p.stkcod, p.stkdes, s.loccod, coalesce('Loc ' || n.n_name, '') AS locdes, s.locbal, p.qucod, coalesce(u.r_name, '') AS qudes,
      CAST((CASE WHEN mills % 1000 > 500 OR (mills % 1000 = 500 AND (mills // 1000) % 2 = 1) THEN mills // 1000 + 1 ELSE mills // 1000 END) AS {q.M}) / 100 AS raw_price,
      s.locval, coalesce(g.n_name, '') AS category, s.lmovdat
    FROM stloc s JOIN products p ON trim(s.stkcod) = p.stkcod
    LEFT JOIN nation n ON s.loccod = lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')
    LEFT JOIN region u ON p.qucod = CAST(u.r_regionkey AS VARCHAR)
    LEFT JOIN nation g ON p.stkgrp = CAST(g.n_nationkey AS VARCHAR)
    WHERE s.status = 'A'""".replace(
        "AS DECIMAL(15,2)) / 100 AS raw_price", "AS BIGINT) AS cents"
    ).replace("SELECT p.stkcod, p.stkdes, s.loccod", "SELECT * EXCLUDE (cents), CAST(cents / 100.0 AS DECIMAL(15,2)) AS unitpr FROM (SELECT p.stkcod, p.stkdes, s.loccod")
    + ")",
)
def stock_by_location(spark, sf):
    li = ad.table(spark, sf, "lineitem")
    stloc = li.select(
        F.concat(F.lit(" "), ad.sku(F.col("l_partkey"))).alias("stkcod"),
        F.lpad((F.col("l_suppkey") % 30).cast("string"), 2, "0").alias("loccod"),
        F.col("l_quantity").cast(MONEY).alias("locbal"),
        (F.col("l_extendedprice").cast(MONEY) * F.lit("0.005").cast("decimal(4,3)")).alias("unitpr"),
        F.col("l_extendedprice").cast(MONEY).alias("locval"),
        F.to_date("l_shipdate").alias("lmovdat"),
        F.col("l_returnflag").alias("status"),
    )
    n = ad.table(spark, sf, "nation")
    places = n.select(
        F.lit("21").alias("tabtyp"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("typcod"),
        F.concat(F.lit("Loc "), F.col("n_name")).alias("typdes"),
    )
    out = stock.stock_by_location(stloc, ad.products(spark, sf), ad.units(spark, sf), ad.groups(spark, sf), places)
    return out.orderBy(*stock.STOCK_ORDER)
