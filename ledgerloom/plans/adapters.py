"""Driver tables -> the domain frames the operators work on. Every frame covers its whole source table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.schemas import MONEY

RUN_DATE = dt.date(1998, 6, 15)
RUN_TS = dt.datetime(1998, 6, 15, 9, 0, 0)
BANK_START = dt.date(2024, 1, 8)

# total order of line items: they have no position of their own
LINE_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def padded(key: Column) -> Column:
    digits = key.cast("string")
    return F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits)


def customer_code(key: Column) -> Column:
    return F.concat(
        (key % 9 + 1).cast("string"), F.lit("-"), F.lpad((key % 100).cast("string"), 2, "0"), F.lit("-"), key.cast("string")
    )


def sku(key: Column) -> Column:
    return F.concat(F.lit("SKU-"), key.cast("string"))


def ledger_docnum(key: Column) -> Column:
    """Invoices IV, OL, CM; credits SR, SC carry the number of the order three before, every other one with '-1'."""
    kind = key % 5
    credit = kind >= 3
    return F.concat(
        pick(["IV", "OL", "CM", "SR", "SC"], kind),
        padded(F.when(credit, key - 3).otherwise(key)),
        F.when(credit & (key % 2 == 0), F.lit("-1")).otherwise(F.lit("")),
    )


def artrn(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast(MONEY)
    total = (amount - (k % 7)).cast(MONEY)
    term = ((F.col("o_custkey") % 4) * 30).cast("int")
    date = F.to_date("o_orderdate")
    rest = F.when(F.col("o_orderstatus") == "O", total).when(F.col("o_orderstatus") == "P", F.lit(100)).otherwise(F.lit(0))
    return o.select(
        ledger_docnum(k).alias("docnum"),
        date.alias("docdat"),
        F.when(
            (k % 5 >= 3) & (k % 3 != 0), F.concat(F.when(k % 5 == 3, F.lit("IV")).otherwise(F.lit("OL")), padded(k - 3))
        ).alias("sonum"),
        customer_code(F.col("o_custkey")).alias("cuscod"),
        amount.alias("amount"),
        (amount - total).cast(MONEY).alias("disc"),
        total.alias("total"),
        total.alias("netval"),
        rest.cast(MONEY).alias("remamt"),
        term.alias("paytrm"),
        F.col("o_orderstatus").alias("dlvby"),
        F.col("o_orderstatus").alias("docstat"),
        F.when(k % 11 == 0, F.lit("~"))
        .when(k % 13 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("B"), F.floor(k / 4).cast("bigint").cast("string")))
        .alias("bilnum"),
        F.date_add(date, term).alias("duedat"),
        k.alias("line_no"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger header table as a target holds it."""
    return artrn(spark, sf_dir).withColumnsRenamed(
        {"docnum": "doc_number", "docdat": "doc_date", "cuscod": "customer_code", "docstat": "doc_stat"}
    )


def ar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receivable documents with deposits: kinds IV, OL, CM, SR, AI, RE."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    total = F.col("o_totalprice").cast(MONEY)
    date = F.to_date("o_orderdate")
    return o.select(
        F.concat(pick(["IV", "OL", "CM", "SR", "AI", "RE"], k % 6), padded(k)).alias("docnum"),
        date.alias("docdat"),
        F.date_add(date, ((F.col("o_custkey") % 4) * 30).cast("int")).alias("duedat"),
        customer_code(F.col("o_custkey")).alias("cuscod"),
        total.alias("netval"),
        F.when(F.col("o_orderstatus") == "O", total).otherwise(F.lit(0)).cast(MONEY).alias("remamt"),
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(pick(["RE", "RC", "RD", "RM", "AI", "AC", "IV"], k % 7), padded(k)).alias("docnum"),
        F.date_add(F.to_date("o_orderdate"), 10000).alias("docdat"),
        customer_code(F.col("o_custkey")).alias("cuscod"),
    )


def payables(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(pick(["HI", "HP", "PS", "PN", "XX"], k % 5), padded(k)).alias("docnum"),
        F.date_add(F.to_date("o_orderdate"), 10000).alias("docdat"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 100).cast("string")).alias("supcod"),
    )


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    day = F.to_date("ts")
    cheque = pick(["QR", "BT", "*", "C"], k % 4)
    return e.select(
        F.when(k % 2 == 0, F.concat(pick(["RE", "RC", "RD", "RM", "AI", "AC", "IV"], k % 7), padded(k)))
        .otherwise(F.concat(pick(["HI", "HP", "PS", "PN", "XX"], k % 5), padded(k)))
        .alias("voucher"),
        F.concat(cheque, k.cast("string")).alias("chqnum"),
        day.alias("trndat"),
        F.when(k % 10 != 9, F.concat(F.lit("ACC"), (F.col("user_id") % 12).cast("string"))).alias("bnkacc"),
        F.when(k % 3 != 0, F.date_add(day, 1)).alias("payindat"),
        F.col("value").cast(MONEY).alias("netamt"),
        F.date_add(day, (k % 5).cast("int")).alias("chqdat"),
        F.when(k % 6 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit(" "))).alias("remark"),
        F.when(k % 2 == 0, F.lit("Y")).alias("cmplapp"),
        F.when((F.floor(k / 4) % 4) == 0, F.lit("BT"))
        .when((F.floor(k / 4) % 4) == 1, F.lit("BX"))
        .when((F.floor(k / 4) % 4) == 3, F.lit("QQ"))
        .alias("bktrntyp"),
        F.when(k % 8 != 1, customer_code(F.col("user_id"))).alias("cuscod"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        customer_code(F.col("c_custkey")).alias("cuscod"),
        F.col("c_name").alias("cusnam"),
        F.col("c_acctbal").cast(MONEY).alias("crline"),
        ((F.col("c_custkey") % 4) * 30).cast("int").alias("paytrm"),
    )


def sale_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas by customer-code prefix of three lengths, from nations and suppliers."""
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier")
    one = n.where("n_nationkey BETWEEN 1 AND 7").select(
        F.concat(F.lit("AREA"), F.col("n_nationkey").cast("string")).alias("sale_area"), F.col("n_nationkey").cast("string").alias("cuscod_startwith")
    )
    two = n.select(
        F.concat(F.lit("ZONE"), F.col("n_nationkey").cast("string")).alias("sale_area"),
        F.concat((F.col("n_nationkey") % 9 + 1).cast("string"), F.lit("-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("cuscod_startwith"),
    )
    three = s.select(F.concat(F.lit("SHOP"), F.col("s_suppkey").cast("string")).alias("sale_area"), customer_code(F.col("s_suppkey")).alias("cuscod_startwith"))
    return one.unionByName(two).unionByName(three)


def details(spark: SparkSession, sf_dir: str, sku_modulus: int | None = None) -> DataFrame:
    """Document lines; sku_modulus folds the SKUs so that invoices and their credits share some."""
    li = table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey") % sku_modulus if sku_modulus else F.col("l_partkey")
    return li.select(
        ledger_docnum(F.col("l_orderkey")).alias("docnum"),
        F.to_date("l_shipdate").alias("docdat"),
        F.col("l_linenumber").cast("int").alias("seqnum"),
        sku(part).alias("stkcod"),
        F.concat(F.lit("item "), part.cast("string")).alias("stkdes"),
        F.col("l_linestatus").alias("people"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").cast(MONEY).alias("trnqty"),
        F.when(part % 7 == 3, 0).otherwise(part % 5 + 10).cast(MONEY).alias("unitpr"),
        F.col("l_discount").cast(MONEY).cast("string").alias("disc"),
        F.col("l_extendedprice").cast(MONEY).alias("trnval"),
        *LINE_ORDER,
    )


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    kind = F.col("l_suppkey") % 9
    sign = F.when(kind.isin(6, 7) & (F.col("l_linestatus") == "O"), F.lit(-1)).otherwise(F.lit(1))
    return li.select(
        F.concat(pick(["IV", "OL", "PD", "HI", "RR", "LL", "JU", "TK", "RI"], kind), padded(F.col("l_orderkey"))).alias("docnum"),
        F.to_date("l_shipdate").alias("docdat"),
        sku(F.col("l_partkey")).alias("stkcod"),
        (F.col("l_quantity").cast(MONEY) * sign).cast(MONEY).alias("trnqty"),
        F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(F.col("l_extendedprice")).cast(MONEY).alias("unitpr"),
        F.col("l_extendedprice").cast(MONEY).alias("trnval"),
        (F.col("l_linenumber") % 2).cast("string").alias("posopr"),
        F.concat(F.lit("STCRD"), F.year("l_shipdate").cast("string"), F.lit(".DBF")).alias("source_file"),
        F.year("l_shipdate").alias("file_no"),
        *LINE_ORDER,
    )


def stock_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = F.when(k % 3 != 0, F.col("p_retailprice")).otherwise(F.lit(0)).cast(MONEY)
    first = F.lit(dt.date(1996, 1, 1))
    return p.select(
        sku(k).alias("stkcod"),
        F.col("p_size").cast(MONEY).alias("totbal"),
        price.alias("unitpr"),
        (F.col("p_size") * price).cast(MONEY).alias("totval"),
        F.when(k % 2 == 0, F.date_add(first, (k % 1000).cast("int"))).alias("lpurdat"),
        F.col("p_retailprice").cast(MONEY).alias("lpurpr"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        sku(k).alias("stkcod"),
        F.col("p_name").alias("stkdes"),
        F.concat(F.lit("885"), k.cast("string")).alias("barcod"),
        (k % 30).cast("string").alias("acccod"),
        (F.col("p_size") % 28).cast("string").alias("stkgrp"),
        (k % 6).cast("string").alias("qucod"),
        F.when(k % 4 != 0, F.col("p_retailprice")).cast(MONEY).alias("unitpr"),
    )


GOODS_EXCLUDED = ("NATION_3", "NATION_7")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("acccod"), F.concat(F.lit("ACC "), F.col("n_name")).alias("accdes"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("typcod"), F.col("n_name").alias("typdes"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("string").alias("typcod"), F.col("r_name").alias("typdes"))


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(sku(F.col("s_suppkey")).alias("sku"), F.concat(F.lit("E"), F.col("s_nationkey").cast("string")).alias("owner"))


def white_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(sku(F.col("s_suppkey")).alias("stkcod"))


def remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remarks of order documents: short, long and no order tokens, commas and runs of blanks."""
    li = table(spark, sf_dir, "lineitem")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    token = (
        F.when((k % 4 == 0) & (n == 3), F.concat(F.lit("//24010"), k.cast("string"), F.lit(")")))
        .when(k % 4 == 1, F.concat(F.lit("// "), n.cast("string"), F.lit(")")))
        .otherwise(F.lit(""))
    )
    body = F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit("  ,"), token, F.lit("   ok "), F.col("l_returnflag"))
    return li.select(
        ledger_docnum(k).alias("docnum"),
        n.cast("string").alias("seqnum"),
        F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").alias("line_no"),
        F.when(n == 7, F.lit("")).otherwise(body).alias("remark"),
    ).where(F.substring("docnum", 1, 2).isin("IV", "CM", "OL"))
