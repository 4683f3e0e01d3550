"""Receivable and cash queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import dates, numbers, text
from ledgerloom.operators import cash, receivables
from ledgerloom.plans import adapters as ad
from ledgerloom.plans import sqlparts as q
from ledgerloom.plans.registry import query

_SALE = "left(docnum, 2) IN ('IV','CM','OL')"
# exact: cents / 6, rounded half up, in whole numbers (sums are not negative)
_AVG = f"""CAST(((CAST(coalesce(sum(netval) FILTER ({_SALE} AND docdat >= DATE '1997-12-15'), 0) * 100 AS BIGINT) * 2 + 6) // 12)
    * CAST(0.01 AS DECIMAL(3,2)) AS {q.T})"""


def _money(expr: str) -> str:
    return f"CAST(coalesce({expr}, 0) AS {q.T})"


@query(
    "customer_avg_sales",
    f"""WITH {q.CUSTOMERS}, {q.AR_DOCS}, s AS (SELECT cuscod, {_AVG} AS avg_sales FROM ardocs GROUP BY cuscod)
    SELECT c.*, {_money('s.avg_sales')} AS avg_sales FROM customers c LEFT JOIN s USING (cuscod)""",
)
def customer_avg_sales(spark, sf):
    return receivables.customer_avg_sales(ad.ar_documents(spark, sf), ad.customers(spark, sf), ad.RUN_DATE)


_REMAIN = f"""{_money(f"sum(remamt) FILTER ({_SALE})")} AS remaining_amt,
    {_money(f"sum(remamt) FILTER ({_SALE} AND CAST(duedat AS TIMESTAMP) < {q.RUN_TS})")} AS remaining_morethan_duedat"""


@query("customer_receivables", f"WITH {q.AR_DOCS} SELECT cuscod, {_REMAIN} FROM ardocs WHERE {_SALE} GROUP BY cuscod")
def customer_receivables(spark, sf):
    return receivables.customer_receivables(ad.ar_documents(spark, sf), ad.RUN_TS)


_CHEQUES = f"SELECT cuscod, {_money('sum(netamt)')} AS chq_payindat_isnull FROM bank WHERE starts_with(chqnum, 'QR') AND payindat IS NULL AND cuscod IS NOT NULL GROUP BY cuscod"
_DEPOSITS = f"SELECT cuscod, {_money('sum(remamt)')} AS ai_notuse FROM ardocs WHERE left(docnum, 2) = 'AI' AND remamt > 0 GROUP BY cuscod"


@query("uncleared_cheques", f"WITH {q.BANK} {_CHEQUES}")
def uncleared_cheques(spark, sf):
    return receivables.uncleared_cheques(ad.bank(spark, sf))


@query("unused_deposits", f"WITH {q.AR_DOCS} {_DEPOSITS}")
def unused_deposits(spark, sf):
    return receivables.unused_deposits(ad.ar_documents(spark, sf))


@query(
    "customer_credit_profile",
    f"""WITH {q.CUSTOMERS}, {q.AR_DOCS}, {q.BANK}, s AS (SELECT cuscod, {_AVG} AS avg_sales, {_REMAIN} FROM ardocs GROUP BY cuscod),
    ch AS ({_CHEQUES}), de AS ({_DEPOSITS})
    SELECT c.cuscod AS customer_code, c.cusnam AS customer_name, {_money('s.avg_sales')} AS avg_sales, c.crline AS credit_limit, c.paytrm,
      {_money('s.remaining_amt')} AS remaining_amt, {_money('s.remaining_morethan_duedat')} AS remaining_morethan_duedat,
      {_money('ch.chq_payindat_isnull')} AS chq_payindat_isnull, {_money('de.ai_notuse')} AS ai_notuse
    FROM customers c LEFT JOIN s USING (cuscod) LEFT JOIN ch USING (cuscod) LEFT JOIN de USING (cuscod)""",
)
def customer_credit_profile(spark, sf):
    return receivables.customer_credit_profile(ad.customers(spark, sf), ad.ar_documents(spark, sf), ad.bank(spark, sf), ad.RUN_TS)


START = dt.date(2022, 6, 1)
_S = "DATE '2022-06-01'"
_SIDES = f"""sides AS (
  SELECT docnum, docdat, 'out' AS type, NULL AS cuscod, supcod FROM payables WHERE left(docnum, 2) IN ('HI','HP','PS','PN') AND docdat >= {_S}
  UNION ALL SELECT docnum, docdat, 'in', cuscod, NULL FROM receipts WHERE left(docnum, 2) IN ('RE','RC','RD','RM','AI','AC') AND docdat >= {_S}),
  booked AS (SELECT s.docnum, s.docdat, s.type, s.cuscod, s.supcod, regexp_replace(b.chqnum, '^\\*', '') AS chqnum, b.trndat, b.bnkacc, b.payindat,
    b.netamt AS net_amt, b.trndat AS "date", b.chqdat, nullif(trim(b.remark), '') AS remark, b.cmplapp
    FROM sides s JOIN bank b ON b.voucher = s.docnum WHERE b.bnkacc IS NOT NULL)"""
_BT = f"""bt AS (SELECT chqnum AS docnum, CAST(NULL AS DATE) AS docdat, CASE WHEN bktrntyp = 'BT' THEN 'out' WHEN starts_with(bktrntyp, 'B') THEN 'in' END AS type,
    cuscod, CAST(NULL AS VARCHAR) AS supcod, chqnum, trndat, bnkacc, payindat, netamt AS net_amt,
    CASE WHEN bktrntyp <> 'BT' AND starts_with(bktrntyp, 'B') THEN chqdat ELSE trndat END AS "date", chqdat, nullif(trim(remark), '') AS remark, cmplapp
  FROM bank WHERE starts_with(chqnum, 'BT') AND trndat >= {_S})"""


@query(
    "bank_ledger_merge",
    f"""WITH {q.RECEIPTS}, {q.BANK} SELECT r.docnum, r.docdat, r.cuscod, b.chqnum, b.trndat, b.bnkacc, b.payindat, b.netamt AS net_amt, b.chqdat, b.remark, b.cmplapp
    FROM receipts r LEFT JOIN bank b ON r.docnum = b.voucher WHERE b.bnkacc IS NOT NULL""",
)
def bank_ledger_merge(spark, sf):
    return cash.bank_ledger_merge(ad.receipts(spark, sf), ad.bank(spark, sf))


@query(
    "bt_customer_backfill",
    f"""WITH {q.BANK}, {q.RECEIPTS} SELECT b.voucher AS docnum, b.chqnum, coalesce(b.cuscod, r.cuscod) AS cuscod
    FROM bank b LEFT JOIN receipts r ON b.voucher = r.docnum""",
)
def bt_customer_backfill(spark, sf):
    rows = ad.bank(spark, sf).select(F.col("voucher").alias("docnum"), "chqnum", "cuscod")
    return cash.bt_customer_backfill(rows, ad.receipts(spark, sf))


@query(
    "cash_ledger",
    f"WITH {q.PAYABLES}, {q.RECEIPTS}, {q.BANK}, {_SIDES}, {_BT} SELECT * FROM booked UNION ALL SELECT * FROM bt WHERE bnkacc IS NOT NULL",
)
def cash_ledger(spark, sf):
    return cash.cash_ledger(ad.payables(spark, sf), ad.receipts(spark, sf), ad.bank(spark, sf), START)


@query(
    "bank_accounts",
    f"""SELECT 'ACC' || CAST(s_suppkey AS VARCHAR) AS bnkacc, s_name AS bnknam, CAST(NULL AS VARCHAR) AS branch, CASE WHEN s_nationkey % 2 = 0 THEN 'S' || CAST(s_nationkey AS VARCHAR) END AS shortnam,
    CAST(s_suppkey AS VARCHAR) AS bnknum, CAST(s_acctbal AS {q.M}) AS balfwd, DATE '2024-01-01' AS baldat, CAST(NULL AS VARCHAR) AS accnum, CAST(NULL AS VARCHAR) AS userid,
    CAST(NULL AS DATE) AS chgdat, CAST(NULL AS VARCHAR) AS taxid, CAST(NULL AS VARCHAR) AS orgnum FROM supplier""",
)
def bank_accounts(spark, sf):
    s = ad.table(spark, sf, "supplier")
    short = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("S"), F.col("s_nationkey").cast("string"), F.lit(" "))).otherwise(F.lit("  "))
    return cash.bank_accounts(
        s.select(
            F.concat(F.lit("ACC"), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("BNKACC"),
            F.col("s_name").alias("BNKNAM"),
            short.alias("SHORTNAM"),
            F.col("s_suppkey").cast("string").alias("BNKNUM"),
            F.col("s_acctbal").alias("BALFWD"),
            F.lit(dt.date(2024, 1, 1)).alias("BALDAT"),
        )
    )


@query(
    "filtered_dumps",
    f"""WITH {q.PAYABLES}, {q.RECEIPTS}, {q.BANK}
    SELECT 'APTRN' AS dump, docnum, docdat AS dated FROM payables WHERE left(docnum, 2) IN ('HI','HP','PS','PN') AND docdat >= {_S}
    UNION ALL SELECT 'ARTRN', docnum, docdat FROM receipts WHERE left(docnum, 2) IN ('RE','RC','RD','RM','AI','AC') AND docdat >= {_S}
    UNION ALL SELECT 'APRCPIT', docnum, docdat FROM payables WHERE left(docnum, 2) IN ('HI','HP','PS','PN')
    UNION ALL SELECT 'BKTRN', chqnum, trndat FROM bank WHERE trndat >= DATE '2024-01-08'""",
)
def filtered_dumps(spark, sf):
    payables, receipts = ad.payables(spark, sf), ad.receipts(spark, sf)
    dumps = {
        "APTRN": cash.filtered_dump(payables, "docnum", cash.PAYABLE_PREFIXES, "docdat", START).select("docnum", "docdat"),
        "ARTRN": cash.filtered_dump(receipts, "docnum", cash.RECEIPT_PREFIXES, "docdat", START).select("docnum", "docdat"),
        "APRCPIT": cash.filtered_dump(payables, "docnum", cash.PAYABLE_PREFIXES, None, None).select("docnum", "docdat"),
        "BKTRN": cash.filtered_dump(ad.bank(spark, sf), None, (), "trndat", ad.BANK_START).select("chqnum", "trndat"),
    }
    out = None
    for name, df in dumps.items():
        rows = df.toDF("docnum", "dated").select(F.lit(name).alias("dump"), "docnum", "dated")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "bank_flow_type",
    f"WITH {q.BANK} SELECT chqnum, bktrntyp, CASE WHEN bktrntyp = 'BT' THEN 'out' WHEN bktrntyp LIKE 'B%' THEN 'in' END AS type FROM bank",
)
def bank_flow_type(spark, sf):
    return ad.bank(spark, sf).select("chqnum", "bktrntyp", numbers.bank_flow_type(F.col("bktrntyp")).alias("type"))


@query("cheque_number_clean", f"WITH {q.BANK} SELECT voucher, CASE WHEN starts_with(chqnum, '*') THEN substr(chqnum, 2) ELSE chqnum END AS chqnum FROM bank")
def cheque_number_clean(spark, sf):
    return ad.bank(spark, sf).select("voucher", text.cheque_number_clean(F.col("chqnum")).alias("chqnum"))


@query(
    "payment_date_rule",
    f"WITH {q.BANK} SELECT chqnum, trndat AS by_transaction, coalesce(payindat, trndat, chqdat) AS by_first_known FROM bank",
)
def payment_date_rule(spark, sf):
    cols = F.col("trndat"), F.col("payindat"), F.col("chqdat")
    return ad.bank(spark, sf).select(
        "chqnum",
        dates.payment_date_rule(*cols).alias("by_transaction"),
        dates.payment_date_rule(*cols, rule="first_known").alias("by_first_known"),
    )


@query(
    "payment_state_label",
    """SELECT event_id, state, payment_state, CASE WHEN state = 'posted' THEN CASE payment_state WHEN 'not_paid' THEN 'Not Paid' WHEN 'in_payment' THEN 'In Payment'
      WHEN 'paid' THEN 'Paid' WHEN 'partial' THEN 'Partially Paid' WHEN 'reversed' THEN 'Reversed' WHEN 'invoicing_legacy' THEN 'Invoicing App Legacy' END
      WHEN state = 'draft' THEN 'Draft.' WHEN state = 'cancel' THEN 'Cancel.' END AS label
    FROM (SELECT event_id, ['posted','posted','draft','cancel'][event_id % 4 + 1] AS state,
      ['not_paid','in_payment','paid','partial','reversed','invoicing_legacy','other'][event_id % 7 + 1] AS payment_state FROM events)""",
)
def payment_state_label(spark, sf):
    k = F.col("event_id")
    e = ad.table(spark, sf, "events").select(
        k,
        ad.pick(["posted", "posted", "draft", "cancel"], k % 4).alias("state"),
        ad.pick(["not_paid", "in_payment", "paid", "partial", "reversed", "invoicing_legacy", "other"], k % 7).alias("payment_state"),
    )
    return e.withColumn("label", numbers.payment_state_label(F.col("state"), F.col("payment_state")))
