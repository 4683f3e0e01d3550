"""Queries of the scans and sinks: Spark writes files from the tables, the scans read them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom import session, sinks
from ledgerloom.functions import dates
from ledgerloom.operators import catalog
from ledgerloom.plans import adapters as ad
from ledgerloom.plans import jobs, staging
from ledgerloom.plans import sqlparts as q
from ledgerloom.plans.registry import query
from ledgerloom.schemas import MONEY
from ledgerloom.sources import dbf, lines, tables

_ARTRN_FIELDS = [
    ("DOCNUM", "C", 12, 0), ("DOCDAT", "D", 8, 0), ("SONUM", "C", 12, 0), ("CUSCOD", "C", 16, 0), ("AMOUNT", "N", 15, 2),
    ("TOTAL", "N", 15, 2), ("PAYTRM", "N", 3, 0), ("DOCSTAT", "C", 10, 0),
]


@query(
    "dbf_scan",
    f"""WITH {q.ARTRN} SELECT docnum, docdat, sonum, cuscod, total, paytrm, 'ไทย' || docstat AS docstat FROM artrn
    WHERE line_no % 10 <> 0 AND docdat BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
)
def dbf_scan(spark, sf):
    docs = ad.artrn(spark, sf).withColumn("docstat", F.concat(F.lit("ไทย"), F.col("docstat")))
    folder = staging.write_dbf(docs, _ARTRN_FIELDS, F.lit("ARTRN"), F.col("line_no") % 10 == 0)
    fields = ["DOCNUM", "DOCDAT", "SONUM", "CUSCOD", "TOTAL", "PAYTRM", "DOCSTAT"]
    scanned = dbf.dbf_scan(
        spark, folder, fields, date_field="DOCDAT", start=dt.date(1996, 1, 1), end=dt.date(1999, 12, 31), split_bytes=1 << 18
    )
    return scanned.select(
        "docnum", "docdat", F.nullif("sonum", F.lit("")).alias("sonum"), "cuscod", F.col("total").cast(MONEY).alias("total"),
        F.col("paytrm").cast("int").alias("paytrm"), "docstat",
    )


_STCRD_FIELDS = [("DOCNUM", "C", 12, 0), ("DOCDAT", "D", 8, 0), ("STKCOD", "C", 20, 0), ("TRNQTY", "N", 15, 2)]


@query(
    "dbf_multi_file_union",
    f"""WITH {q.MOVES} SELECT left(source_file, 9) AS year_file, docnum, docdat, stkcod, trnqty FROM moves""",
)
def dbf_multi_file_union(spark, sf):
    moves = ad.moves(spark, sf)
    folder = staging.write_dbf(moves, _STCRD_FIELDS, F.substring("source_file", 1, 9), F.lit(False))
    union = dbf.dbf_multi_file_union(spark, [folder], ["DOCNUM", "DOCDAT", "STKCOD", "TRNQTY"])
    return union.select(
        F.substring("source_file", 1, 9).alias("year_file"), "docnum", "docdat", "stkcod", F.col("trnqty").cast(MONEY).alias("trnqty")
    )


@query(
    "report_csv_scan",
    """SELECT CAST(event_id AS VARCHAR) AS "A", CASE WHEN event_id % 3 <> 0 THEN event_type || ', ไทย' END AS "B", CAST(user_id AS VARCHAR) AS "C",
    CASE WHEN event_id % 5 <> 0 THEN CAST(user_id * 2 AS VARCHAR) END AS "D" FROM events WHERE event_id % 7 <> 0""",
)
def report_csv_scan(spark, sf):
    k = F.col("event_id")
    text = F.when(k % 3 != 0, F.concat(F.lit('"'), F.col("event_type"), F.lit(', ไทย"'))).otherwise(F.lit(""))
    last = F.when(k % 5 != 0, F.concat(F.lit(","), (F.col("user_id") * 2).cast("string"))).otherwise(F.lit(""))
    # every seventh line has too many cells
    bad = F.when(k % 7 == 0, F.lit(",x,y,z")).otherwise(F.lit(""))
    line = F.concat(k.cast("string"), F.lit(","), text, F.lit(","), F.col("user_id").cast("string"), last, bad)
    folder = staging.write_dump(ad.table(spark, sf, "events"), line, "dump", "รายงาน\r\n,,\r\nhead,head\r\n")
    return lines.report_csv_scan(spark, folder, 3, 4, split_bytes=1 << 16).select("A", "B", "C", "D")


_ODD_CELL = """CASE event_id % 6 WHEN 0 THEN event_type || chr(10) || 'ไทย, ' || chr(10) || user_id WHEN 1 THEN 'a "quoted" word' WHEN 2 THEN NULL WHEN 3 THEN event_type
    WHEN 4 THEN chr(13) || chr(10) || ',,' ELSE '5" pipe' END"""


@query(
    "report_csv_scan_quoted",
    f"""SELECT CAST(event_id AS VARCHAR) AS "A", {_ODD_CELL} AS "B", CAST(user_id AS VARCHAR) AS "C",
    CASE WHEN event_id % 5 <> 0 THEN CAST(user_id * 2 AS VARCHAR) END AS "D" FROM events WHERE event_id % 7 <> 0""",
)
def report_csv_scan_quoted(spark, sf):
    """Cells with line feeds, commas and quotes, words for absent values, and records that cross the borders of small ranges."""
    k, kind = F.col("event_id"), F.col("event_type")
    second = (
        F.when(k % 6 == 0, F.concat(F.lit('"'), kind, F.lit('\nไทย, \n'), F.col("user_id").cast("string"), F.lit('"')))
        .when(k % 6 == 1, F.lit('"a ""quoted"" word"'))
        .when(k % 6 == 2, ad.pick(["NA", "NULL", '"nan"', ""], F.floor(k / 6) % 4))
        .when(k % 6 == 3, kind)
        .when(k % 6 == 4, F.lit('"\r\n,,"'))
        .otherwise(F.lit('5" pipe'))
    )
    last = F.when(k % 5 != 0, F.concat(F.lit(',"'), (F.col("user_id") * 2).cast("string"), F.lit('"'))).otherwise(F.lit(""))
    bad = F.when(k % 7 == 0, F.lit(',x,"\n",z')).otherwise(F.lit(""))
    line = F.concat(k.cast("string"), F.lit(","), second, F.lit(","), F.col("user_id").cast("string"), last, bad)
    folder = staging.write_dump(ad.table(spark, sf, "events"), line, "quoted-dump", 'รายงาน\r\n"a title\nof two lines",,\r\nhead,head\r\n')
    return lines.report_csv_scan(spark, folder, 3, 4, split_bytes=1 << 14).select("A", "B", "C", "D")


@query(
    "jdbc_scan",
    f"SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 1000",
)
def jdbc_scan(spark, sf):
    # the extract of the customer table stands for the database table; see jdbc_options for the parallel read
    return tables.jdbc_scan(spark, f"{sf}/customer.parquet", ["c_custkey", "c_name", "c_acctbal"], "c_acctbal > 1000")


def _pair(key, name):
    """[id, "name"] as the record service writes it."""
    return F.concat(F.lit("["), key.cast("string"), F.lit(', "'), name, F.lit('"]'))


def _json(**fields):
    parts = []
    for name, value in fields.items():
        parts += [F.lit(f'"{name}": '), value, F.lit(", ")]
    return F.concat(F.lit("{"), *parts[:-1], F.lit("}"))


def _quoted(c):
    return F.concat(F.lit('"'), c, F.lit('"'))


def product_records(spark, sf):
    """Product templates as JSON lines: pairs, id lists, false where empty."""
    p = ad.table(spark, sf, "part")
    k = F.col("p_partkey")
    ids = F.concat(F.lit("["), (k * 3).cast("string"), F.lit(", "), (k * 3 + 1).cast("string"),
                   F.when(k % 10 == 0, F.concat(F.lit(", "), (k * 3).cast("string"))).otherwise(F.lit("")), F.lit("]"))
    record = _json(
        id=k.cast("string"),
        name=_quoted(F.col("p_name")),
        categ_id=_pair(F.col("p_size"), F.concat(F.lit("Made / "), F.col("p_type"))),
        uom_id=F.when(k % 4 == 0, F.lit("false")).otherwise(_pair(k % 5, F.lit("unit"))),
        width_min=F.lit("0.5"),
        width_max=F.lit("3.7"),
        height_min=F.lit("0.5"),
        height_max=F.lit("3.0"),
        route_ids=F.lit("[5]"),
        size_based_on=F.when(k % 3 == 0, F.lit("false")).otherwise(_pair(k % 7, F.lit("area"))),
        create_date=_quoted(F.lit("2024-01-01")),
        __last_update=_quoted(F.lit("2024-01-02")),
        attribute_line_ids=ids,
    )
    return p, record


@query(
    "paged_snapshot_scan",
    """SELECT p_partkey AS product_id, p_name AS name, CAST(p_size AS BIGINT) AS product_cate_id, CASE WHEN p_partkey % 4 <> 0 THEN 'unit' END AS uom,
    CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey % 7 AS BIGINT) END AS formula_id, 0.5::DOUBLE AS width_min FROM part""",
)
def paged_snapshot_scan(spark, sf):
    parts, record = product_records(spark, sf)
    folder = staging.write_lines(parts, record, "snapshot")
    raw = tables.paged_snapshot_scan(spark, folder, catalog.raw_schema("products"))
    return catalog.config_snapshot(raw, "products").select("product_id", "name", "product_cate_id", "uom", "formula_id", "width_min")


_PAGE = 20


def _pages(spark, sf):
    """Part records in pages of 20: each fifth page is lost, each seventh comes a second time, read later and with other names, one record short."""
    p = ad.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_partkey", "p_name")
    rows = p.withColumn("page", F.floor(F.col("k") / _PAGE)).where("page % 5 <> 4")
    again = rows.where(f"page % 7 = 3 AND k % {_PAGE} > 0").withColumn("p_name", F.concat(F.lit("new "), "p_name"))
    both = rows.withColumn("read_no", F.col("page")).unionByName(again.withColumn("read_no", F.col("page") + 1_000_000))
    listed = F.array_sort(F.collect_list(F.struct("k", F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")).alias("record"))))
    total = ad.table(spark, sf, "part").count()
    pages = both.groupBy("page", "read_no").agg(F.min("k").alias("offset"), listed.getField("record").alias("records"))
    document = F.to_json(F.struct(F.lit("product").alias("model"), F.lit(total).alias("count"), "offset", "read_no", "records"))
    folder = staging.write_lines(pages, document, "pages")
    return tables.snapshot_pages(spark, folder, "struct<id: long, name: string>")


_PAGE_ROWS = f"page_rows AS (SELECT *, p_partkey AS k, CAST(floor(p_partkey / {_PAGE}) AS BIGINT) AS page FROM part)"


@query(
    "paged_snapshot_records",
    f"""WITH {_PAGE_ROWS} SELECT 'product' AS model, p_partkey AS id, CASE WHEN page % 7 = 3 AND k % {_PAGE} > 0 THEN 'new ' || p_name ELSE p_name END AS name
    FROM page_rows WHERE page % 5 <> 4""",
)
def paged_snapshot_records(spark, sf):
    return tables.snapshot_records(_pages(spark, sf))


@query(
    "paged_snapshot_findings",
    f"""WITH {_PAGE_ROWS}, pages AS (SELECT page, min(k) AS first, max(k) + 1 AS behind FROM page_rows GROUP BY page)
    SELECT 'product' AS model, 'repeated' AS finding, first + 1 AS first, behind FROM pages WHERE page % 7 = 3 AND page % 5 <> 4 AND behind - first > 1
    UNION ALL SELECT 'product', 'missing', first, behind FROM pages WHERE page % 5 = 4""",
)
def paged_snapshot_findings(spark, sf):
    return tables.snapshot_findings(_pages(spark, sf))


def _feed(spark, sf):
    """One feed document per event with two rates."""
    k = F.col("event_id")
    first = ad.pick(["USD", "CNY", "MYR", "EUR"], k % 4)
    period = dates.iso_to_thai_date(F.to_date("ts"))
    rate = F.col("value").cast("decimal(15,2)").cast("string")
    body = F.struct(
        F.array(
            F.struct(first.alias("currency_id"), period.alias("period"), rate.alias("selling")),
            F.struct(F.lit("JPY").alias("currency_id"), period.alias("period"), F.lit("0.25").alias("selling")),
        ).alias("responseContent")
    )
    return ad.table(spark, sf, "events").select("event_id", F.to_json(body).alias("json"))


_MONTHS = "[" + ", ".join(f"'{m}'" for m in dates.THAI_MONTHS) + "]"
_FEED = f"""feed AS (SELECT event_id, ['USD','CNY','MYR','EUR'][event_id % 4 + 1] AS currency_id,
    CAST(day(ts) AS VARCHAR) || ' ' || {_MONTHS}[month(ts)] || ' ' || CAST(year(ts) + 543 AS VARCHAR) AS period,
    CAST(CAST(value AS {q.M}) AS VARCHAR) AS selling FROM events WHERE event_id % 4 < 3)"""


@query("rate_feed_scan", f"WITH {_FEED} SELECT * FROM feed")
def rate_feed_scan(spark, sf):
    return tables.rate_feed_scan(_feed(spark, sf))


@query(
    "exchange_rate_load",
    f"""WITH {_FEED} SELECT period AS name, CASE currency_id WHEN 'USD' THEN 2 WHEN 'CNY' THEN 7 WHEN 'MYR' THEN 34 END AS currency_id,
    CAST(selling AS DECIMAL(15,4)) AS inverse_company_rate FROM feed""",
)
def exchange_rate_load(spark, sf):
    return jobs.exchange_rate_load(tables.rate_feed_scan(_feed(spark, sf)))


@query(
    "sheet_lines_scan",
    f"""SELECT ['no1','no2','no3','self_checkout'][l_suppkey % 4 + 1] AS store, CAST(l_partkey AS VARCHAR) AS sku,
    CAST(l_quantity AS INTEGER) AS quantity, CAST(CAST(l_extendedprice AS {q.M}) AS DOUBLE) AS unit_price FROM lineitem""",
)
def sheet_lines_scan(spark, sf):
    li = ad.table(spark, sf, "lineitem")
    line = F.concat_ws(
        ",", F.col("l_partkey").cast("string"), F.lit("name"), F.col("l_quantity").cast("string"), F.col("l_extendedprice").cast("decimal(15,2)").cast("string")
    )
    head = "\r\n" * 5 + ",".join(["SKU", "name", *lines.SHEET_TITLES[1:]]) + "\r\n"
    sheets = {
        store: staging.write_dump(li.where(F.col("l_suppkey") % 4 == i), line, f"sheet-{store}", head, "utf-8")
        for i, store in enumerate(["no1", "no2", "no3", "self_checkout"])
    }
    return lines.sheet_lines_scan(spark, sheets).select("store", "sku", "quantity", "unit_price")


@query("link_list_scan", "SELECT DISTINCT trim(url) AS url FROM pages")
def link_list_scan(spark, sf):
    pages = ad.table(spark, sf, "pages")
    twice = pages.unionByName(pages)
    return lines.link_list_scan(spark, staging.write_lines(twice, F.concat(F.lit(" "), F.col("url"), F.lit(" ")), "links"))


@query("full_refresh_write", f"WITH {q.MASTER} SELECT stkcod, totbal, unitpr, totval FROM master")
def full_refresh_write(spark, sf):
    path = session.scratch_path(spark, "table")
    master = ad.stock_master(spark, sf).select("stkcod", "totbal", "unitpr", "totval")
    sinks.full_refresh_write(master.withColumn("totbal", F.lit(0).cast(MONEY)), path)
    sinks.full_refresh_write(master, path)
    return spark.read.parquet(path)


@query(
    "replace_date_range_write",
    f"""WITH {q.HEADERS}, months AS (SELECT doc_number, CASE WHEN line_no % 5 <> 0 THEN doc_date END AS doc_date, total, amount, line_no FROM headers)
    SELECT doc_number, doc_date, amount AS total FROM months WHERE doc_date IS NULL OR NOT doc_date BETWEEN DATE '1997-03-10' AND DATE '1998-09-20'
    UNION ALL SELECT doc_number, doc_date, total FROM months""",
)
def replace_date_range_write(spark, sf):
    path = session.scratch_path(spark, "months")
    headers = ad.headers(spark, sf).withColumn("doc_date", F.when(F.col("line_no") % 5 != 0, F.col("doc_date")))
    sinks.write_months(headers.select("doc_number", "doc_date", F.col("amount").alias("total")), path, "doc_date")
    start, end = dt.date(1997, 3, 10), dt.date(1998, 9, 20)
    # new rows inside the range, behind it, before it and without a date
    sinks.replace_date_range_write(
        spark, path, headers.select("doc_number", "doc_date", "total"), "doc_date", start, end, session.scratch_path(spark, "staged")
    )
    return spark.read.parquet(path).drop(sinks.MONTH)


@query(
    "report_export",
    f"""WITH {q.MOVES} SELECT 'raw' AS sheet, stkcod, CAST(trnqty AS VARCHAR) AS trnqty FROM moves WHERE unitpr = 0
    UNION ALL SELECT 'grouped', stkcod, CAST(CAST(sum(trnqty) AS {q.T}) AS VARCHAR) FROM moves WHERE unitpr = 0 GROUP BY stkcod""",
)
def report_export(spark, sf):
    raw = ad.moves(spark, sf).where("unitpr = 0").select("stkcod", "trnqty")
    grouped = raw.groupBy("stkcod").agg(F.sum("trnqty").cast("decimal(18,2)").alias("trnqty"))
    path = session.scratch_path(spark, "report")
    sinks.report_export({"raw": raw, "grouped": grouped}, path)
    out = None
    for sheet in ("raw", "grouped"):
        rows = spark.read.csv(f"{path}/{sheet}", header=True, schema="stkcod string, trnqty string")
        rows = rows.select(F.lit(sheet).alias("sheet"), "stkcod", "trnqty")
        out = rows if out is None else out.unionByName(rows)
    return out
