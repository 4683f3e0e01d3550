"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import dates, numbers, text, titles
from ledgerloom.operators import catalog, filters
from ledgerloom.plans import adapters as ad
from ledgerloom.plans import sqlparts as q
from ledgerloom.plans.registry import query
from ledgerloom.schemas import conform, struct


@query("status_filter", "SELECT CAST(l_partkey AS VARCHAR) AS stkcod, l_returnflag AS status, l_quantity FROM lineitem WHERE l_returnflag = 'A' AND l_partkey % 10 <> 0")
def status_filter(spark, sf):
    li = ad.table(spark, sf, "lineitem").select(
        F.when(F.col("l_partkey") % 10 == 0, F.lit("  ")).otherwise(F.col("l_partkey").cast("string")).alias("stkcod"),
        F.col("l_returnflag").alias("status"),
        "l_quantity",
    )
    return filters.status_filter(li)


@query("excluded_group_filter", "SELECT n_nationkey, n_name FROM nation WHERE n_name NOT IN ('NATION_3', 'NATION_7') AND n_nationkey % 5 <> 0")
def excluded_group_filter(spark, sf):
    n = ad.table(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("n_name"))
    return filters.excluded_group_filter(n, "n_name", ad.GOODS_EXCLUDED)


@query(
    "domain_filter",
    "SELECT p_partkey, p_name, p_type, p_size FROM part WHERE (contains(lower(p_name), 'red') OR p_type IN ('PROMO', 'SMALL')) AND p_size <> 5",
)
def domain_filter(spark, sf):
    p = ad.table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")
    wanted = filters.any_of(("p_name", "ilike", "RED"), ("p_type", "in", ["PROMO", "SMALL"]))
    return filters.domain_filter(p, filters.all_of(wanted, ("p_size", "!=", 5), ("p_partkey", "set", True)))


@query(
    "domain_filter_prefix",
    """SELECT p_partkey, p_name, p_type, p_size FROM part WHERE (contains(lower(p_name), 'red') OR (p_type IN ('PROMO', 'SMALL') AND NOT p_size > 20)) AND p_size <> 5
    AND p_brand NOT IN ('Brand#11', 'Brand#12')""",
)
def domain_filter_prefix(spark, sf):
    p = ad.table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_brand")
    form = ["|", ["p_name", "ilike", "RED"], "&", ["p_type", "in", ["PROMO", "SMALL"]], "!", ["p_size", ">", 20], ["p_size", "!=", 5], ("p_brand", "not in", ["Brand#11", "Brand#12"])]
    return filters.domain_filter(p, form).drop("p_brand")


@query(
    "blank_to_null",
    "SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN event_type ELSE event_type END AS cleaned FROM events",
)
def blank_to_null(spark, sf):
    k = F.col("event_id")
    raw = F.when(k % 6 < 4, ad.pick(["  ", "~", "None\t", " nan"], k % 6)).otherwise(F.concat(F.lit("\t"), F.col("event_type"), F.lit("  ")))
    return ad.table(spark, sf, "events").select(k, text.blank_to_null(raw).alias("cleaned"))


@query("numeric_or_zero", f"SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE value END AS {q.M}) AS amount FROM events")
def numeric_or_zero(spark, sf):
    k = F.col("event_id")
    raw = F.when(k % 6 == 0, F.lit("n/a")).when(k % 3 != 0, F.concat(F.lit(" "), F.col("value").cast("decimal(15,2)").cast("string")))
    return ad.table(spark, sf, "events").select(k, numbers.numeric_or_zero(F.trim(raw)).alias("amount"))


@query("date_or_null", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def date_or_null(spark, sf):
    k = F.col("o_orderkey")
    raw = F.when(k % 8 == 0, F.lit("19981301")).when(k % 4 == 0, F.lit("        ")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return ad.table(spark, sf, "orders").select(k, dates.date_or_null(raw).alias("day"))


@query("conform", f"SELECT CAST(o_orderkey AS VARCHAR) AS docnum, CAST(o_orderdate AS DATE) AS docdat, CAST(o_totalprice AS {q.M}) AS total, CAST(NULL AS VARCHAR) AS remark FROM orders")
def conform_query(spark, sf):
    o = ad.table(spark, sf, "orders").select(F.col("o_totalprice").alias("TOTAL"), F.col("o_orderkey").alias("DOCNUM"), F.to_date("o_orderdate").alias("DOCDAT"))
    return conform(o, struct("docnum string, docdat date, total money, remark string"))


@query(
    "text_match_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|part ' || CAST(l_partkey % 7 AS VARCHAR) || ' ABC' AS match_key FROM lineitem",
)
def text_match_key(spark, sf):
    # full-width letters and an ideographic blank on odd lines, plain text on even ones
    wide = F.when(F.col("l_linenumber") % 2 == 1, F.lit("　ＡＢＣ ")).otherwise(F.lit("  ABC"))
    description = F.concat(F.lit(" part  "), (F.col("l_partkey") % 7).cast("string"), wide)
    key = text.text_match_key(F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), description)
    return ad.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", key.alias("match_key"))


@query(
    "control_char_strip",
    "SELECT doc_id, regexp_replace(text, '[\\x00-\\x1F\\x7F\u0080-\u009f]', '', 'g') AS all_off, regexp_replace(text, '[\\x00-\\x08\\x0B-\\x1F\\x7F]', '', 'g') AS sheet FROM documents",
)
def control_char_strip(spark, sf):
    c = F.col("text")
    return ad.table(spark, sf, "documents").select(
        "doc_id", text.control_char_strip(c).alias("all_off"), text.control_char_strip(c, keep_tab_newline=True).alias("sheet")
    )


@query("leading_thai_strip", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 'ก' ELSE '' END || p_brand AS code FROM part")
def leading_thai_strip(spark, sf):
    k = F.col("p_partkey")
    raw = F.concat(F.when(k % 3 == 0, F.lit("ผ")).when(k % 3 == 1, F.lit("ผก")).otherwise(F.lit("")), F.col("p_brand"))
    return ad.table(spark, sf, "part").select(k, text.leading_thai_strip(raw).alias("code"))


@query("bracket_code", "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS code FROM part")
def bracket_code(spark, sf):
    raw = F.when(F.col("p_partkey") % 4 == 0, F.col("p_name")).otherwise(F.concat(F.lit("["), F.col("p_brand"), F.lit("] "), F.col("p_name"), F.lit(" [x]")))
    return ad.table(spark, sf, "part").select("p_partkey", text.bracket_code(raw).alias("code"))


@query(
    "fabric_code",
    """SELECT p_partkey, ltrim(CASE p_partkey % 3 WHEN 0 THEN p_type || ' ' || CAST(p_size AS VARCHAR) || '-' || CAST(p_partkey AS VARCHAR)
      WHEN 1 THEN ' ' || p_type ELSE NULL END) AS code,
      CASE p_partkey % 3 WHEN 0 THEN p_type || ' ' || CAST(p_size AS VARCHAR) || '-' || CAST(p_partkey AS VARCHAR)
      WHEN 1 THEN 'B ' ELSE '' END AS code_upper FROM part""",
)
def fabric_code(spark, sf):
    k, kind = F.col("p_partkey"), F.col("p_type")
    raw = (
        F.when(k % 3 == 0, F.concat(F.lit("ผ้า"), kind, F.lit(" "), F.col("p_size").cast("string"), F.lit("-"), k.cast("string")))
        .when(k % 3 == 1, F.concat(F.lit("Black out "), kind))
        .otherwise(F.lit("ม่านพลาสติก"))
    )
    upper = F.when(k % 3 == 1, F.lit("ผ้า B ม่าน")).otherwise(F.when(k % 3 == 0, F.regexp_replace(raw, "ผ้า", "ผ้า ")).otherwise(raw))
    return ad.table(spark, sf, "part").select(k, text.fabric_code(raw).alias("code"), text.fabric_code_upper(upper).alias("code_upper"))


_TITLES = ["Dr. ", "Dr", "คุณหมอ ", "คุณ", "บมจ.ธนาคาร", ""]
_TITLE_LIST = ", ".join("'" + t + "'" for t in dict.fromkeys(titles.HONORIFICS))


@query(
    "honorific_split",
    f"""WITH named AS (SELECT c_custkey, [{", ".join("'" + t + "'" for t in _TITLES)}][c_custkey % 6 + 1] || c_name AS n FROM customer),
    best AS (SELECT c_custkey, n, coalesce((SELECT arg_max(t, length(t)) FROM (SELECT unnest([{_TITLE_LIST}]) AS t) WHERE starts_with(n, t)), '') AS title FROM named)
    SELECT c_custkey, title, CASE WHEN title = '' THEN n ELSE trim(substr(n, length(title) + 1)) END AS rest FROM best""",
)
def honorific_split(spark, sf):
    name = F.concat(ad.pick(_TITLES, F.col("c_custkey") % 6), F.col("c_name"))
    title, rest = text.honorific_split(name)
    return ad.table(spark, sf, "customer").select("c_custkey", title.alias("title"), rest.alias("rest"))


@query(
    "category_path_split",
    "SELECT p_partkey, p_type || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ' ' END AS first_part, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE p_name END AS last_part FROM part",
)
def category_path_split(spark, sf):
    path = F.when(F.col("p_partkey") % 5 == 0, F.col("p_type")).otherwise(F.concat_ws(" / ", "p_type", "p_brand", "p_name"))
    first, last = text.category_path_split(path)
    return ad.table(spark, sf, "part").select("p_partkey", first.alias("first_part"), last.alias("last_part"))


@query("nbsp_to_space", "SELECT p_partkey, p_name AS plain, replace(p_name, ' ', chr(160)) AS hard FROM part")
def nbsp_to_space(spark, sf):
    hard = text.space_to_nbsp(F.col("p_name"))
    return ad.table(spark, sf, "part").select("p_partkey", text.nbsp_to_space(hard).alias("plain"), hard.alias("hard"))


@query(
    "thai_date_to_iso",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
)
def thai_date_to_iso(spark, sf):
    raw = F.when(F.col("o_orderkey") % 6 == 0, F.lit("28 xx 2567")).otherwise(dates.iso_to_thai_date(F.to_date("o_orderdate")))
    return ad.table(spark, sf, "orders").select("o_orderkey", dates.thai_date_to_iso(raw).alias("day"))


@query(
    "local_to_utc",
    "SELECT event_id, date_trunc('second', ts) - INTERVAL 7 HOUR AS order_utc, CAST(ts AS DATE) AS delivery FROM events",
)
def local_to_utc(spark, sf):
    written = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    return ad.table(spark, sf, "events").select(
        "event_id",
        dates.local_to_utc(written).alias("order_utc"),
        dates.delivery_date(F.date_format("ts", "dd/MM/yyyy")).alias("delivery"),
    )


@query("currency_id_map", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 7 WHEN 2 THEN 34 END AS currency_id FROM events")
def currency_id_map(spark, sf):
    code = ad.pick(["USD", "CNY", "MYR", "EUR"], F.col("event_id") % 4)
    return ad.table(spark, sf, "events").select("event_id", numbers.currency_id_map(code).alias("currency_id"))


@query(
    "zero_to_dash",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN '-' WHEN 1 THEN '-' WHEN 2 THEN event_type ELSE CAST(event_id AS VARCHAR) || '.50' END AS cell FROM events",
)
def zero_to_dash(spark, sf):
    k = F.col("event_id")
    raw = F.when(k % 4 == 0, F.lit("0.00")).when(k % 4 == 1, F.lit(" 0")).when(k % 4 == 2, F.col("event_type")).otherwise(F.concat(k.cast("string"), F.lit(".50")))
    return ad.table(spark, sf, "events").select(k, text.zero_to_dash(raw).alias("cell"))


@query(
    "settlement_note",
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'Invoice = ' || event_type || ' paid = ' || CASE WHEN event_id % 3 = 1 THEN CAST(event_id AS VARCHAR) ELSE 'nan' END END AS note FROM events",
)
def settlement_note(spark, sf):
    k = F.col("event_id")
    settled = F.when(k % 3 == 0, F.lit("-")).when(k % 3 == 1, k.cast("string"))
    return ad.table(spark, sf, "events").select(k, numbers.settlement_note(F.col("event_type"), settled, ("Invoice = ", " paid = ")).alias("note"))


@query(
    "area_price",
    """SELECT p_partkey, w * h AS area, w * h * 1.2::DOUBLE AS quantity, CASE WHEN w * h < 1 THEN (1.2::DOUBLE - w * h * 1.2::DOUBLE) * p_retailprice END AS addon, p_retailprice AS value
    FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) / 32 AS w, CAST(p_partkey % 16 + 1 AS DOUBLE) / 8 AS h, p_retailprice FROM part)""",
)
def area_price(spark, sf):
    width = F.col("p_size").cast("double") / F.lit(32.0)
    height = (F.col("p_partkey") % 16 + 1).cast("double") / F.lit(8.0)
    priced = numbers.area_price(width, height, F.col("p_retailprice"))
    return ad.table(spark, sf, "part").select("p_partkey", *[c.alias(n) for n, c in priced.items()])


_HOST = "https://shop.example"


@query(
    "url_product_id",
    "SELECT page_id, replace(replace(url, 'https://m.', ''), '/', '') AS product_id FROM pages",
)
def url_product_id(spark, sf):
    return ad.table(spark, sf, "pages").select("page_id", text.url_product_id(F.col("url"), "https://m.").alias("product_id"))


@query("absolute_url", f"SELECT page_id, CASE WHEN contains(url, 'https') THEN url ELSE '{_HOST}' || url END AS link FROM pages")
def absolute_url(spark, sf):
    return ad.table(spark, sf, "pages").select("page_id", text.absolute_url(F.col("url"), _HOST).alias("link"))


@query("safe_file_name", "SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}_\\-. ]', '_', 'g') AS file_name FROM pages")
def safe_file_name(spark, sf):
    return ad.table(spark, sf, "pages").select("page_id", text.safe_file_name(F.col("url")).alias("file_name"))


@query("name_swap", "SELECT c_custkey, c_mktsegment AS firstname, c_name AS lastname FROM customer")
def name_swap(spark, sf):
    people = ad.table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("firstname"), F.col("c_mktsegment").alias("lastname"))
    return catalog.swap_names(people)
