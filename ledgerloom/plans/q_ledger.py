"""Ledger queries: filters, joins, credit matching, allocation, cost status, due dates, remarks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom import session, sinks
from ledgerloom.functions import dates, numbers
from ledgerloom.operators import filters, ledger, matching, refresh
from ledgerloom.plans import adapters as ad
from ledgerloom.plans import jobs
from ledgerloom.plans import sqlparts as q
from ledgerloom.plans.registry import query
from ledgerloom.schemas import INVOICE_HEADER, MONEY

START, END = dt.date(1996, 1, 1), dt.date(1999, 12, 31)
_RANGE = "docdat BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
_IV = f"invoices AS (SELECT * FROM artrn WHERE {_RANGE} AND left(docnum, 2) IN ('IV','OL','CM'))"
_CR = f"credits AS (SELECT * FROM artrn WHERE {_RANGE} AND left(docnum, 2) IN ('SC','SR','SL'))"


def _documents(spark, sf):
    return ledger.ledger_documents(ad.artrn(spark, sf), START, END)


@query("doc_prefix_filter", f"WITH {q.ARTRN} SELECT docnum, docdat, total FROM artrn WHERE left(docnum, 2) IN ('IV','SR')")
def doc_prefix_filter(spark, sf):
    return filters.doc_prefix_filter(ad.artrn(spark, sf), "docnum", ["IV", "SR"]).select("docnum", "docdat", "total")


@query("date_range_filter", f"WITH {q.ARTRN} SELECT docnum, docdat, total FROM artrn WHERE {_RANGE}")
def date_range_filter(spark, sf):
    return filters.date_range_filter(ad.artrn(spark, sf), "docdat", START, END).select("docnum", "docdat", "total")


@query(
    "trailing_months_range",
    f"WITH {q.ARTRN} SELECT docnum, docdat FROM artrn WHERE docdat >= date_trunc('month', {q.RUN_DATE} - INTERVAL 3 MONTH) AND docdat <= {q.RUN_DATE}",
)
def trailing_months_range(spark, sf):
    start, end = dates.trailing_months_range(ad.RUN_DATE, 3)
    return filters.date_range_filter(ad.artrn(spark, sf), "docdat", start, end).select("docnum", "docdat")


@query(
    "previous_n_calendar_months",
    f"""WITH {q.ARTRN} SELECT docnum, docdat FROM artrn
    WHERE docdat >= date_trunc('month', DATE '1998-02-10' - INTERVAL 3 MONTH) AND docdat < DATE '1998-02-01'""",
)
def previous_n_calendar_months(spark, sf):
    return filters.previous_months_filter(ad.artrn(spark, sf), "docdat", dt.date(1998, 2, 10), 3).select("docnum", "docdat")


@query(
    "year_month_filter",
    f"WITH {q.ARTRN} SELECT docnum, docdat FROM artrn WHERE year(docdat) IN (1997, 1998) AND month(docdat) IN (1, 2, 12)",
)
def year_month_filter(spark, sf):
    return filters.year_month_filter(ad.artrn(spark, sf), "docdat", [1997, 1998], [1, 2, 12]).select("docnum", "docdat")


@query("document_discount", f"WITH {q.ARTRN} SELECT docnum, CAST(amount - total AS {q.M}) AS disc FROM artrn WHERE left(docnum, 2) IN ('IV','OL','CM')")
def document_discount(spark, sf):
    sales = filters.doc_prefix_filter(ad.artrn(spark, sf), "docnum", ledger.INVOICE_PREFIXES)
    return sales.select("docnum", numbers.document_discount(F.col("amount"), F.col("total")).alias("disc"))


@query(
    "unit_price_fallback",
    f"""WITH {q.MOVES} SELECT docnum, stkcod, unitpr AS price_zero, CASE WHEN unitpr = 0 THEN trnval ELSE unitpr END AS price_value FROM moves""",
)
def unit_price_fallback(spark, sf):
    price, value = F.col("unitpr"), F.col("trnval")
    return ad.moves(spark, sf).select(
        "docnum",
        "stkcod",
        numbers.unit_price_fallback(price, value).alias("price_zero"),
        numbers.unit_price_fallback(price, value, "value").alias("price_value"),
    )


@query(
    "credit_semi_join",
    f"""WITH {q.ARTRN}, {_IV}, {_CR} SELECT docnum, sonum, total FROM credits WHERE sonum IN (SELECT docnum FROM invoices)""",
)
def credit_semi_join(spark, sf):
    invoices, credits = _documents(spark, sf)
    return ledger.credit_semi_join(credits, invoices).select("docnum", "sonum", "total")


@query(
    "credit_prefix_semi_join",
    f"""WITH {q.ARTRN}, {_IV}, {_CR}, bare AS (SELECT DISTINCT substr(docnum, 3) AS b FROM invoices)
    SELECT c.docnum, c.total FROM credits c WHERE EXISTS (SELECT 1 FROM bare WHERE substr(c.docnum, 3) = b OR substr(c.docnum, 3, length(c.docnum) - 4) = b)""",
)
def credit_prefix_semi_join(spark, sf):
    invoices, credits = _documents(spark, sf)
    return ledger.credit_prefix_semi_join(credits, invoices).select("docnum", "total")


@query("base_number_key", f"WITH {q.ARTRN} SELECT docnum, substr(docnum, 3, 7) AS base_number FROM artrn")
def base_number_key(spark, sf):
    return ad.artrn(spark, sf).select("docnum", ledger.base_number("docnum").alias("base_number"))


@query(
    "detail_split",
    f"""WITH {q.ARTRN}, {q.details()}, {_IV}, {_CR}
    SELECT 'invoice' AS kind, docnum, seqnum, stkcod, trnqty FROM details WHERE docnum IN (SELECT docnum FROM invoices)
    UNION ALL SELECT 'credit', docnum, seqnum, stkcod, trnqty FROM details WHERE docnum IN (SELECT docnum FROM credits)""",
)
def detail_split(spark, sf):
    invoice_lines, credit_lines = ledger.detail_split(ad.details(spark, sf), *_documents(spark, sf))

    def tagged(df, kind):
        return df.select(F.lit(kind).alias("kind"), "docnum", "seqnum", "stkcod", "trnqty")

    return tagged(invoice_lines, "invoice").unionByName(tagged(credit_lines, "credit"))


@query(
    "customer_enrich",
    f"""WITH {q.ARTRN}, {q.CUSTOMERS} SELECT a.docnum, a.cuscod, c.cusnam AS customer_name, c.cusnam AS customer_group,
    coalesce(c.paytrm, 0) AS paytrm FROM artrn a LEFT JOIN customers c USING (cuscod)""",
)
def customer_enrich(spark, sf):
    out = ledger.customer_enrich(ad.artrn(spark, sf), ad.customers(spark, sf))
    return out.select("docnum", "cuscod", "customer_name", "customer_group", "paytrm")


@query(
    "customer_group_rule",
    f"WITH {q.CUSTOMERS} SELECT cuscod, CASE WHEN starts_with(cuscod, '3') THEN cusnam ELSE 'อื่นๆ' END AS customer_group FROM customers",
)
def customer_group_rule(spark, sf):
    rule = ledger.customer_group_rule(F.col("cuscod"), F.col("cusnam"))
    return ad.customers(spark, sf).select("cuscod", rule.alias("customer_group"))


@query(
    "cost_enrich",
    f"""WITH {q.details()}, {q.PRODUCTS} SELECT d.docnum, d.seqnum, d.stkcod, d.trnqty, coalesce(p.unitpr, 0) AS cost
    FROM details d LEFT JOIN products p USING (stkcod)""",
)
def cost_enrich(spark, sf):
    out = ledger.cost_enrich(ad.details(spark, sf), ad.products(spark, sf))
    return out.select("docnum", "seqnum", "stkcod", "trnqty", "cost")


_REMARK_SQL = f"""{q.REMARKS}, tokens AS (
    SELECT docnum, seqnum, row_number() OVER (ORDER BY docnum, seqnum, {q.LINE_ORDER}) AS pos,
      regexp_extract_all(remark, '//\\s*(\\d{{6,}})(?:$|\\s|\\))', 1) AS longs, regexp_extract_all(remark, '//\\s*(\\d+)\\)', 1) AS shorts FROM remarks),
  longs AS (SELECT docnum, arg_min(longs[1], pos) AS first_long FROM tokens WHERE len(longs) > 0 GROUP BY 1),
  shorts AS (SELECT docnum, string_agg('SO' || token, ',' ORDER BY pos) AS short_list FROM (
    SELECT docnum, token, min(pos) AS pos FROM (SELECT docnum, pos, unnest(shorts) AS token FROM tokens) GROUP BY 1, 2) GROUP BY 1),
  joined AS (SELECT docnum, string_agg(remark, ' | ' ORDER BY seqnum, {q.LINE_ORDER}) FILTER (remark <> '') AS t FROM remarks GROUP BY 1),
  consolidated AS (SELECT j.docnum, CAST(0 AS INTEGER) AS part_no,
    nullif(regexp_replace(regexp_replace(trim(regexp_replace(t, '//\\s*\\d+\\)?', '', 'g')), '\\s{{2,}}', ' ', 'g'), '\\s*,\\s*', ', ', 'g'), '') AS remark,
    coalesce('SO' || first_long, short_list) AS so_number
    FROM joined j LEFT JOIN longs USING (docnum) LEFT JOIN shorts USING (docnum))"""


@query("remark_consolidate", f"WITH {_REMARK_SQL} SELECT * FROM consolidated")
def remark_consolidate(spark, sf):
    return ledger.remark_consolidate(ad.remarks(spark, sf))


@query(
    "remark_enrich",
    f"""WITH {_REMARK_SQL}, {q.ARTRN} SELECT a.docnum, a.total, c.remark, c.so_number FROM artrn a LEFT JOIN consolidated c USING (docnum)""",
)
def remark_enrich(spark, sf):
    consolidated = ledger.remark_consolidate(ad.remarks(spark, sf))
    return ledger.remark_enrich(ad.artrn(spark, sf), consolidated).select("docnum", "total", "remark", "so_number")


_AREA_SQL = f"""{q.AREAS}, {q.CUSTOMERS}, codes AS (SELECT cuscod, (SELECT arg_max(sale_area, length(cuscod_startwith))
    FROM areas WHERE starts_with(cuscod, cuscod_startwith)) AS sale_area_code FROM customers)"""


@query(
    "sale_area_longest_prefix",
    f"WITH {q.ARTRN}, {_AREA_SQL} SELECT a.docnum, a.cuscod AS customer_code, c.sale_area_code FROM artrn a LEFT JOIN codes c USING (cuscod)",
)
def sale_area_longest_prefix(spark, sf):
    docs = ad.artrn(spark, sf).select("docnum", F.col("cuscod").alias("customer_code"))
    return matching.sale_area_longest_prefix(docs, ad.sale_areas(spark, sf))


_DEALER = f"""dealer AS (SELECT * FROM artrn WHERE {_RANGE} AND left(docnum, 2) = 'IV' AND left(cuscod, 1) IN ('1','2','3')),
  notes AS (SELECT *, split_part(substr(docnum, 3), '-', 1) AS base FROM artrn WHERE {_RANGE} AND left(docnum, 2) IN ('SR','SC'))"""
_NETTED = f"""{_DEALER}, netted AS (SELECT d.docnum, d.docdat, d.cuscod, d.amount, d.disc, d.total,
    CAST(coalesce(sum(n.total), 0) AS {q.T}) AS credit_total, CAST(d.total - coalesce(sum(n.total), 0) AS {q.T}) AS net_total,
    string_agg(n.docnum, ',' ORDER BY n.line_no) AS debit_note_refs
  FROM dealer d LEFT JOIN notes n ON substr(d.docnum, 3) = n.base
  GROUP BY d.docnum, d.docdat, d.cuscod, d.amount, d.disc, d.total)"""


def _dealer(spark, sf):
    return ledger.dealer_documents(ad.artrn(spark, sf), START, END)


@query(
    "credit_suffix_match",
    f"""WITH {q.ARTRN}, {_DEALER} SELECT d.docnum AS invoice_doc_number, n.docnum AS credit_doc_number, n.total AS credit_total, n.docdat AS credit_date
    FROM dealer d JOIN notes n ON substr(d.docnum, 3) = n.base""",
)
def credit_suffix_match(spark, sf):
    return ledger.credit_suffix_match(*_dealer(spark, sf))


@query("invoice_credit_netting", f"WITH {q.ARTRN}, {_NETTED} SELECT docnum, total, credit_total, net_total, debit_note_refs FROM netted")
def invoice_credit_netting(spark, sf):
    out = ledger.invoice_credit_netting(*_dealer(spark, sf))
    return out.select("docnum", "total", "credit_total", "net_total", "debit_note_refs")


def _known_invoices(docs):
    """Invoices of the target: every third is one of the documents."""
    number = F.when(F.col("line_no") % 3 == 0, F.col("docnum")).otherwise(F.concat(F.lit("?"), F.col("docnum")))
    return docs.select(number.alias("doc_number"))


@query(
    "dealer_invoices",
    f"""WITH {q.ARTRN}, {_NETTED}, {q.CUSTOMERS} SELECT n.docnum AS doc_number, n.docdat AS doc_date, n.cuscod AS customer_code, c.cusnam AS customer_name,
    n.amount, n.disc AS discount, n.total, n.net_total, n.debit_note_refs
    FROM netted n LEFT JOIN customers c USING (cuscod) WHERE n.docnum NOT IN (SELECT docnum FROM artrn WHERE line_no % 3 = 0)""",
)
def dealer_invoices(spark, sf):
    docs = ad.artrn(spark, sf)
    target = _known_invoices(docs)
    return jobs.dealer_invoices(docs, ad.customers(spark, sf), target, START, END)["invoice"]


@query(
    "dealer_invoices_references",
    f"""WITH {q.ARTRN}, {_NETTED} SELECT docnum AS doc_number, CAST(0 AS INTEGER) AS part_no, debit_note_refs FROM netted
    WHERE debit_note_refs IS NOT NULL AND docnum NOT IN (SELECT docnum FROM artrn WHERE line_no % 3 = 0)""",
)
def dealer_invoices_references(spark, sf):
    docs = ad.artrn(spark, sf)
    target = _known_invoices(docs)
    return jobs.dealer_invoices(docs, ad.customers(spark, sf), target, START, END)["references"]


_ALLOC = """SELECT {keep}, CAST(greatest(0, least(hi, coalesce(t, 0)) - (hi - p)) AS DECIMAL(15,2)) AS qty_sc_sr_deducted,
    CAST(trnqty - greatest(0, least(hi, coalesce(t, 0)) - (hi - p)) AS DECIMAL(15,2)) AS qty_balance,
    CASE WHEN greatest(0, least(hi, coalesce(t, 0)) - (hi - p)) > 0 THEN unitpr END AS unit_price_from_sc_sr
  FROM (SELECT *, greatest(trnqty, 0) AS p, sum(greatest(trnqty, 0)) OVER (PARTITION BY {keys}, unitpr ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS hi FROM {lines})
  LEFT JOIN (SELECT {keys}, unitpr, sum(greatest(trnqty, 0)) AS t FROM {credit} GROUP BY ALL) USING ({keys}, unitpr)"""


@query(
    "credit_allocation",
    f"WITH {q.details()}, il AS (SELECT * FROM details WHERE flag <> 'R'), cl AS (SELECT * FROM details WHERE flag = 'R') "
    + _ALLOC.format(keep="docnum, seqnum, stkcod, unitpr, trnqty", keys="stkcod", order=q.LINE_ORDER, lines="il", credit="cl"),
)
def credit_allocation(spark, sf):
    lines = ad.details(spark, sf).select("docnum", "seqnum", "stkcod", "unitpr", "trnqty", "flag", *ad.LINE_ORDER)
    out = ledger.credit_allocation(lines.where("flag <> 'R'"), lines.where("flag = 'R'"), ["stkcod"], "unitpr", ad.LINE_ORDER)
    return out.select(
        "docnum", "seqnum", "stkcod", "unitpr", "trnqty", "qty_sc_sr_deducted", "qty_balance", "unit_price_from_sc_sr"
    )


# fold of the SKUs so that invoices and their credit notes share some
_FOLD = 20
_JOB_LINES = f"""{q.details(_FOLD)}, keyed AS (SELECT *, substr(docnum, 3, 7) AS base FROM details),
  il AS (SELECT * FROM keyed WHERE docnum IN (SELECT docnum FROM invoices)),
  cl AS (SELECT * FROM keyed WHERE docnum IN (SELECT docnum FROM credit_docs)),
  allocated AS ({_ALLOC.format(keep="* EXCLUDE (p, hi, t)", keys="base, stkcod", order=q.LINE_ORDER, lines="il", credit="cl")}),
  detail AS (SELECT a.docnum AS doc_number, a.docdat AS doc_date, a.seqnum, a.stkcod, a.stkdes, a.people, a.flag, a.trnqty, a.unitpr AS unit_price,
     a.disc AS discount, a.trnval, CAST(coalesce(pr.unitpr, 0) AS {q.M}) AS cost, a.qty_sc_sr_deducted, a.qty_balance, a.unit_price_from_sc_sr,
     row_number() OVER (PARTITION BY a.docnum, a.stkcod ORDER BY a.seqnum, {q.LINE_ORDER}) AS row_order
   FROM allocated a LEFT JOIN products pr ON pr.stkcod = a.stkcod)"""
_STATUS = f"""costed AS (SELECT doc_number, CAST(sum(coalesce(cost, 0) * coalesce(qty_balance, 0)) AS {q.M}) AS cost_total,
    CAST(CASE WHEN coalesce(sum(qty_balance), 0) = 0 THEN 2
      WHEN sum(CASE WHEN cost = 0 AND qty_balance > 0 AND stkcod NOT IN (SELECT stkcod FROM white_list) THEN 1 ELSE 0 END) = 0 THEN 1 ELSE 0 END AS INTEGER) AS status
  FROM detail GROUP BY doc_number)"""
_DUE = """due AS (SELECT bilnum, CAST(max(docdat) + max(paytrm) AS DATE) AS due FROM {docs}
  WHERE left(docnum, 2) IN ('IV','CM','OL') AND bilnum IS NOT NULL AND bilnum NOT IN ('', '~') GROUP BY bilnum)"""


_JOB_SQL = f"""WITH {q.ARTRN}, {q.CUSTOMERS}, {q.PRODUCTS}, {q.WHITE_LIST}, {_IV}, {_CR},
  credit_docs AS (SELECT * FROM credits WHERE sonum IN (SELECT docnum FROM invoices)), {_JOB_LINES}, {_STATUS}"""


def _job(spark, sf):
    return jobs.invoice_ledger(
        ad.artrn(spark, sf), ad.remarks(spark, sf), ad.details(spark, sf, _FOLD), ad.customers(spark, sf), ad.sale_areas(spark, sf),
        ad.products(spark, sf), ad.white_list(spark, sf), START, END, ad.LINE_ORDER,
    )


_AREA_ONLY = _AREA_SQL.replace(f"{q.CUSTOMERS}, ", "")


_HEADER_SQL = f"""{_JOB_SQL}, {_AREA_ONLY}, {_REMARK_SQL}, {_DUE.format(docs="invoices")}
    SELECT i.docnum AS doc_number, i.docdat AS doc_date, r.so_number, i.cuscod AS customer_code, c.cusnam AS customer_name, c.cusnam AS customer_group,
      i.amount, i.remamt AS remamount, i.total, k.cost_total, CAST(i.amount - i.total AS {q.M}) AS discount, i.docstat AS doc_stat,
      coalesce(k.status, 0) AS status, coalesce(c.paytrm, 0) AS paytrm, i.dlvby, r.remark,
      CASE WHEN i.bilnum NOT IN ('', '~') THEN i.bilnum END AS bilnum, codes.sale_area_code, coalesce(due.due, i.duedat) AS duedat
    FROM invoices i LEFT JOIN customers c USING (cuscod) LEFT JOIN codes USING (cuscod) LEFT JOIN consolidated r USING (docnum)
    LEFT JOIN costed k ON k.doc_number = i.docnum LEFT JOIN due ON due.bilnum = i.bilnum"""
_CREDIT_LINES_SQL = f"""SELECT c.docnum AS doc_number, c.docdat AS doc_date, c.seqnum, row_number() OVER (PARTITION BY c.docnum, c.stkcod ORDER BY c.seqnum, {q.LINE_ORDER}) AS row_order,
      c.stkcod, c.stkdes, c.people, c.flag, c.trnqty, c.unitpr AS unit_price, c.disc AS discount, c.trnval, CAST(coalesce(pr.unitpr, 0) AS {q.M}) AS cost
    FROM cl c LEFT JOIN products pr ON pr.stkcod = c.stkcod"""


@query("invoice_ledger", _HEADER_SQL)
def invoice_ledger(spark, sf):
    return _job(spark, sf)["header"]


@query(
    "invoice_ledger_remarks",
    f"WITH {q.ARTRN}, {_IV}, {_REMARK_SQL} SELECT docnum AS doc_number, part_no, remark FROM consolidated WHERE remark IS NOT NULL AND docnum IN (SELECT docnum FROM invoices)",
)
def invoice_ledger_remarks(spark, sf):
    return _job(spark, sf)["remark"]


@query("invoice_ledger_detail", f"{_JOB_SQL} SELECT * FROM detail")
def invoice_ledger_detail(spark, sf):
    return _job(spark, sf)["detail"]


@query(
    "invoice_ledger_credit",
    f"""{_JOB_SQL} SELECT d.docnum AS doc_number, d.docdat AS doc_date, d.sonum AS so_number, d.cuscod AS customer_code, c.cusnam AS customer_name,
      c.cusnam AS customer_group, d.amount, d.total, d.docstat AS doc_stat FROM credit_docs d LEFT JOIN customers c USING (cuscod)""",
)
def invoice_ledger_credit(spark, sf):
    return _job(spark, sf)["credit"]


@query("invoice_ledger_credit_lines", f"{_JOB_SQL} {_CREDIT_LINES_SQL}")
def invoice_ledger_credit_lines(spark, sf):
    return _job(spark, sf)["credit_detail"]


_UPDATED = ", ".join(f"CASE WHEN n.doc_number IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in refresh.LEDGER_UPDATE_COLUMNS)
_KEPT = ", ".join(
    f"CASE WHEN o.doc_number IS NOT NULL THEN o.{f.name} ELSE n.{f.name} END AS {f.name}" for f in INVOICE_HEADER.fields if f.name not in refresh.LEDGER_UPDATE_COLUMNS
)


@query(
    "invoice_ledger_refresh",
    f"""WITH header AS ({_HEADER_SQL}),
    target AS (SELECT * REPLACE (CASE WHEN status = 0 THEN CAST(doc_date - 4000 AS DATE) ELSE doc_date END AS doc_date, CAST(amount + 1 AS {q.M}) AS amount, CAST(NULL AS DATE) AS duedat)
      FROM header WHERE paytrm > 0 UNION ALL SELECT * REPLACE ('IX' || doc_number AS doc_number, CAST(doc_date - 4000 AS DATE) AS doc_date) FROM header),
    kept AS (SELECT * FROM target WHERE doc_date IS NULL OR NOT doc_date BETWEEN DATE '{START}' AND DATE '{END}'),
    merged AS (SELECT {_KEPT}, {_UPDATED} FROM kept o FULL JOIN header n ON o.doc_number = n.doc_number),
    bills AS (SELECT bilnum, CAST(max(doc_date) + max(paytrm) AS DATE) AS due FROM merged WHERE left(doc_number, 2) IN ('IV','CM','OL') AND bilnum NOT IN ('', '~') GROUP BY bilnum)
    SELECT m.* REPLACE (CASE WHEN left(doc_number, 2) IN ('IV','CM','OL') THEN coalesce(due, duedat) ELSE duedat END AS duedat)
    FROM merged m LEFT JOIN bills USING (bilnum)""",
)
def invoice_ledger_refresh(spark, sf):
    """The job's headers into a target that holds some of them with other dates and amounts, and others under the same bills."""
    header = session.materialise(_job(spark, sf)["header"], "headers")
    older = F.date_sub("doc_date", 4000)
    target = header.where("paytrm > 0").withColumns(
        {
            "doc_date": F.when(F.col("status") == 0, older).otherwise(F.col("doc_date")),
            "amount": (F.col("amount") + 1).cast(MONEY),
            "duedat": F.lit(None).cast("date"),
        }
    )
    target = target.unionByName(header.withColumns({"doc_number": F.concat(F.lit("IX"), F.col("doc_number")), "doc_date": older}))
    return jobs.merged_headers(target, header, START, END)


@query(
    "invoice_cost_status",
    f"""WITH {q.ARTRN}, {q.PRODUCTS}, {q.WHITE_LIST}, {q.details(_FOLD)}, detail AS (SELECT d.docnum AS doc_number, d.stkcod, coalesce(p.unitpr, 0) AS cost,
      CASE WHEN d.flag = 'R' THEN 0 ELSE d.trnqty END AS qty_balance FROM details d LEFT JOIN products p USING (stkcod)), {_STATUS}
    SELECT a.docnum AS doc_number, a.total, CAST(k.cost_total AS {q.T}) AS cost_total, coalesce(k.status, 0) AS status
    FROM (SELECT docnum, total FROM artrn UNION ALL SELECT 'NL' || docnum, total FROM artrn) a LEFT JOIN costed k ON a.docnum = k.doc_number""",
)
def invoice_cost_status(spark, sf):
    lines = ledger.cost_enrich(ad.details(spark, sf, _FOLD), ad.products(spark, sf)).select(
        F.col("docnum").alias("doc_number"), "stkcod", "cost",
        F.when(F.col("flag") == "R", F.lit(0)).otherwise(F.col("trnqty")).cast(MONEY).alias("qty_balance"),
    )
    headers = ad.headers(spark, sf).select("doc_number", "total")
    # a document without any line is a case of its own
    headers = headers.unionByName(headers.withColumn("doc_number", F.concat(F.lit("NL"), F.col("doc_number"))))
    return ledger.invoice_cost_status(headers, lines, ad.white_list(spark, sf))


@query(
    "ol_sl_ledger",
    f"""WITH {q.ARTRN}, {q.CUSTOMERS}, {q.PRODUCTS}, {q.WHITE_LIST},
    invoices AS (SELECT * FROM artrn WHERE left(docnum, 2) = 'OL' AND year(docdat) IN (1996, 1997, 1998)),
    credit_docs AS (SELECT * FROM artrn WHERE left(docnum, 2) = 'SC' AND substr(docnum, 3, 7) IN (SELECT substr(docnum, 3) FROM invoices)),
    {_JOB_LINES.replace("SELECT *, substr", "SELECT * REPLACE (CASE WHEN unitpr = 0 THEN trnval ELSE unitpr END AS unitpr), substr")}, {_STATUS}
    SELECT i.docnum AS doc_number, i.total, k.cost_total, coalesce(k.status, 0) AS status,
      CASE WHEN starts_with(i.cuscod, '3') THEN c.cusnam ELSE 'อื่นๆ' END AS customer_group
    FROM invoices i LEFT JOIN customers c USING (cuscod) LEFT JOIN costed k ON k.doc_number = i.docnum""",
)
def ol_sl_ledger(spark, sf):
    out = jobs.ol_sl_ledger(
        ad.artrn(spark, sf), ad.details(spark, sf, _FOLD), ad.customers(spark, sf), ad.products(spark, sf), ad.white_list(spark, sf),
        [1996, 1997, 1998], list(range(1, 13)), ad.LINE_ORDER, credit_prefixes=("SC",),
    )
    return out["header"].select("doc_number", "total", "cost_total", "status", "customer_group")


@query(
    "ol_sl_ledger_detail",
    f"""WITH {q.ARTRN}, {q.CUSTOMERS}, {q.PRODUCTS},
    invoices AS (SELECT * FROM artrn WHERE left(docnum, 2) = 'OL' AND year(docdat) IN (1996, 1997, 1998)),
    credit_docs AS (SELECT * FROM artrn WHERE left(docnum, 2) = 'SC' AND sonum IN (SELECT substr(docnum, 3) FROM invoices)),
    {_JOB_LINES.replace("SELECT *, substr", "SELECT * REPLACE (CASE WHEN unitpr = 0 THEN trnval ELSE unitpr END AS unitpr), substr")}
    SELECT * FROM detail""",
)
def ol_sl_ledger_detail(spark, sf):
    """Credits by the invoice number without prefix in their order number."""
    docs = ad.artrn(spark, sf)
    out = jobs.ol_sl_ledger(
        docs, ad.details(spark, sf, _FOLD), ad.customers(spark, sf), ad.products(spark, sf), ad.white_list(spark, sf),
        [1996, 1997, 1998], list(range(1, 13)), ad.LINE_ORDER, credit_prefixes=("SC",), credit_rule="order",
    )
    return out["detail"]


@query(
    "credit_total_by_base",
    f"""WITH {q.ARTRN}, {_CR} SELECT substr(docnum, 3, 7) AS base_number, CAST(sum(total) AS {q.T}) AS credit_total FROM credits GROUP BY 1""",
)
def credit_total_by_base(spark, sf):
    return ledger.credit_total_by_base(_documents(spark, sf)[1], "docnum")


@query(
    "bill_due_date",
    f"""WITH {q.ARTRN}, {_DUE.format(docs="artrn")}
    SELECT a.docnum AS doc_number, a.bilnum, CASE WHEN left(a.docnum, 2) IN ('IV','CM','OL') THEN coalesce(due.due, a.duedat) ELSE a.duedat END AS duedat
    FROM artrn a LEFT JOIN due USING (bilnum)""",
)
def bill_due_date(spark, sf):
    return ledger.bill_due_date(ad.headers(spark, sf)).select("doc_number", "bilnum", "duedat")


@query(
    "bill_due_date_customer_term",
    f"""WITH {q.ARTRN}, {q.CUSTOMERS}, due AS (SELECT bilnum, CAST(last_date + coalesce(c.paytrm, 0) AS DATE) AS due FROM (
        SELECT bilnum, max(docdat) AS last_date, arg_min(cuscod, docnum) AS cuscod FROM artrn
        WHERE left(docnum, 2) IN ('IV','CM','OL') AND bilnum NOT IN ('', '~') GROUP BY bilnum) LEFT JOIN customers c USING (cuscod))
    SELECT a.docnum AS doc_number, a.bilnum, CASE WHEN left(a.docnum, 2) IN ('IV','CM','OL') THEN coalesce(due.due, a.duedat) ELSE a.duedat END AS duedat
    FROM artrn a LEFT JOIN due USING (bilnum)""",
)
def bill_due_date_customer_term(spark, sf):
    out = ledger.bill_due_date(ad.headers(spark, sf), ad.customers(spark, sf), term="customer")
    return out.select("doc_number", "bilnum", "duedat")


@query(
    "monthly_credit_counts",
    f"""WITH {q.ARTRN}, {_IV}, {_CR} SELECT CAST(year(docdat) AS INTEGER) AS year, CAST(month(docdat) AS INTEGER) AS month, count(*) AS documents
    FROM credits WHERE sonum IN (SELECT docnum FROM invoices) GROUP BY ALL""",
)
def monthly_credit_counts(spark, sf):
    invoices, credits = _documents(spark, sf)
    return ledger.monthly_credit_counts(ledger.credit_semi_join(credits, invoices))


@query(
    "line_row_order",
    f"""WITH {q.details(_FOLD)} SELECT docnum, stkcod, seqnum, trnqty,
    row_number() OVER (PARTITION BY docnum, stkcod ORDER BY seqnum, {q.LINE_ORDER}) AS row_order FROM details""",
)
def line_row_order(spark, sf):
    lines = ad.details(spark, sf, _FOLD).select("docnum", "stkcod", "seqnum", "trnqty", *ad.LINE_ORDER)
    out = ledger.line_row_order(lines, ["docnum", "stkcod"], ["seqnum", *ad.LINE_ORDER])
    return out.select("docnum", "stkcod", "seqnum", "trnqty", "row_order")


@query(
    "dedupe_first",
    f"""WITH {q.details()} SELECT docnum, stkcod, seqnum, trnqty FROM (SELECT *, row_number() OVER (PARTITION BY docnum ORDER BY {q.LINE_ORDER}) AS rn
    FROM details) WHERE rn = 1""",
)
def dedupe_first(spark, sf):
    lines = ad.details(spark, sf).select("docnum", "stkcod", "seqnum", "trnqty", *ad.LINE_ORDER)
    return ledger.dedupe_first(lines, "docnum", ad.LINE_ORDER).select("docnum", "stkcod", "seqnum", "trnqty")


# target tables of the refresh queries: the old state knows two thirds of the documents, with older amounts, and others beside them
_OLD = f"""{q.HEADERS}, old AS (SELECT CASE WHEN line_no % 3 <> 0 THEN '' ELSE 'X' END || doc_number AS doc_number, doc_date, customer_code, doc_stat, CAST(amount - 1 AS {q.M}) AS amount, CAST(total - 1 AS {q.M}) AS total, 'old' AS remark FROM headers),
  new AS (SELECT CASE WHEN line_no % 2 = 0 THEN '' ELSE 'Y' END || doc_number AS doc_number, doc_date, customer_code, 'N' AS doc_stat, amount, total, CASE WHEN line_no % 5 <> 0 THEN 'new' END AS remark FROM headers)"""


def _old_new(spark, sf):
    h, line = ad.headers(spark, sf), F.col("line_no")

    def number(shared, mark):
        return F.concat(F.when(shared, F.lit("")).otherwise(F.lit(mark)), F.col("doc_number")).alias("doc_number")

    old = h.select(
        number(line % 3 != 0, "X"), "doc_date", "customer_code", "doc_stat", (F.col("amount") - 1).cast(MONEY).alias("amount"), (F.col("total") - 1).cast(MONEY).alias("total"),
        F.lit("old").alias("remark"),
    )
    new = h.select(
        number(line % 2 == 0, "Y"), "doc_date", "customer_code", F.lit("N").alias("doc_stat"), "amount", "total", F.when(line % 5 != 0, F.lit("new")).alias("remark")
    )
    return old, new


@query(
    "replace_date_range",
    f"""WITH {_OLD} SELECT * FROM old WHERE NOT doc_date BETWEEN DATE '1997-03-10' AND DATE '1998-09-20'
    UNION ALL SELECT * FROM new WHERE doc_date BETWEEN DATE '1997-03-10' AND DATE '1998-09-20'""",
)
def replace_date_range(spark, sf):
    old, new = _old_new(spark, sf)
    start, end = dt.date(1997, 3, 10), dt.date(1998, 9, 20)
    return refresh.replace_date_range(old, filters.date_range_filter(new, "doc_date", start, end), "doc_date", start, end)


@query(
    "ledger_upsert",
    f"""WITH {_OLD} SELECT coalesce(o.doc_number, n.doc_number) AS doc_number, coalesce(o.doc_date, n.doc_date) AS doc_date,
    coalesce(o.customer_code, n.customer_code) AS customer_code, CASE WHEN o.doc_number IS NOT NULL THEN o.doc_stat ELSE n.doc_stat END AS doc_stat,
    CASE WHEN n.doc_number IS NOT NULL THEN n.amount ELSE o.amount END AS amount, CASE WHEN n.doc_number IS NOT NULL THEN n.total ELSE o.total END AS total,
    CASE WHEN n.doc_number IS NOT NULL THEN n.remark ELSE o.remark END AS remark FROM old o FULL JOIN new n ON o.doc_number = n.doc_number""",
)
def ledger_upsert(spark, sf):
    return refresh.ledger_upsert(*_old_new(spark, sf))


@query(
    "ledger_upsert_write",
    f"""WITH {_OLD}, late AS (SELECT * FROM new WHERE doc_date >= DATE '1998-07-15'), months AS (SELECT doc_number, CASE WHEN doc_number LIKE '%7' THEN NULL ELSE doc_date END AS doc_date,
      amount, total, remark FROM old)
    SELECT coalesce(o.doc_number, n.doc_number) AS doc_number, CASE WHEN o.doc_number IS NOT NULL THEN o.doc_date ELSE n.doc_date END AS doc_date,
    CASE WHEN n.doc_number IS NOT NULL THEN n.amount ELSE o.amount END AS amount, CASE WHEN n.doc_number IS NOT NULL THEN n.total ELSE o.total END AS total,
    CASE WHEN n.doc_number IS NOT NULL THEN n.remark ELSE o.remark END AS remark FROM months o FULL JOIN late n ON o.doc_number = n.doc_number""",
)
def ledger_upsert_write(spark, sf):
    """A load of late documents into a table by month; some known ones have no date there."""
    old, new = _old_new(spark, sf)
    cols = ["doc_number", "doc_date", "amount", "total", "remark"]
    path = session.scratch_path(spark, "upsert")
    undated = old.withColumn("doc_date", F.when(~F.col("doc_number").endswith("7"), F.col("doc_date")))
    sinks.write_months(undated.select(*cols), path, "doc_date")
    late = new.where(F.col("doc_date") >= F.lit(dt.date(1998, 7, 15))).select(*cols)
    sinks.ledger_upsert_write(spark, path, late, "doc_date", session.scratch_path(spark, "upsert-staged"))
    return spark.read.parquet(path).drop(sinks.MONTH)


@query("insert_new_only", f"WITH {_OLD} SELECT * FROM new WHERE doc_number NOT IN (SELECT doc_number FROM old)")
def insert_new_only(spark, sf):
    old, new = _old_new(spark, sf)
    return refresh.insert_new_only(old, new, "doc_number")[0]


@query(
    "insert_new_only_counts",
    f"""WITH {_OLD} SELECT count(*) AS candidates, count(*) FILTER (doc_number NOT IN (SELECT doc_number FROM old)) AS inserted,
    count(*) FILTER (doc_number IN (SELECT doc_number FROM old)) AS skipped FROM new""",
)
def insert_new_only_counts(spark, sf):
    old, new = _old_new(spark, sf)
    return refresh.insert_new_only(old, new, "doc_number")[1]


@query(
    "audit_columns",
    f"""WITH {q.ARTRN} SELECT docnum, total, row_number() OVER (ORDER BY docdat, docnum) AS id, {q.RUN_TS} AS created_at, {q.RUN_TS} AS updated_at FROM artrn""",
)
def audit_columns(spark, sf):
    docs = ad.artrn(spark, sf).select("docnum", "docdat", "total")
    return refresh.audit_columns(docs, ad.RUN_TS, ["docdat", "docnum"]).drop("docdat")


@query(
    "union_by_name",
    f"""WITH {q.ARTRN}, {q.RECEIPTS}, {q.PAYABLES} SELECT docnum, docdat, cuscod, NULL AS supcod, total FROM artrn
    UNION ALL SELECT docnum, docdat, cuscod, NULL, NULL FROM receipts UNION ALL SELECT docnum, docdat, NULL, supcod, NULL FROM payables""",
)
def union_by_name(spark, sf):
    docs = ad.artrn(spark, sf).select("docnum", "docdat", "cuscod", "total")
    return refresh.union_by_name(docs, ad.receipts(spark, sf), ad.payables(spark, sf))


@query(
    "set_union",
    f"""WITH {q.ARTRN}, {q.details()} SELECT docnum FROM artrn UNION SELECT docnum FROM details""",
)
def set_union(spark, sf):
    return refresh.set_union(ad.artrn(spark, sf).select("docnum"), ad.details(spark, sf).select("docnum"))


@query("set_difference", f"WITH {q.ARTRN}, {q.details()} SELECT DISTINCT docnum FROM artrn WHERE docnum NOT IN (SELECT docnum FROM details)")
def set_difference(spark, sf):
    return refresh.set_difference(ad.artrn(spark, sf), ad.details(spark, sf), "docnum")
