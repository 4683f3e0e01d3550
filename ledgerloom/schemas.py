"""Declared output schemas and the rule that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

MONEY = T.DecimalType(15, 2)
TOTAL = T.DecimalType(18, 2)


_SIMPLE = {"string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(), "bigint": T.LongType(), "money": MONEY}


def struct(spec: str) -> T.StructType:
    """'name type, name type' -> StructType, without needing a session."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _SIMPLE[kind]) for name, kind in pairs])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order: absent ones become typed nulls, present ones are cast."""
    by_name = {c.lower(): c for c in df.columns}
    cols = []
    for field in schema.fields:
        source = by_name.get(field.name.lower())
        if source is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif df.schema[source].dataType == field.dataType:
            cols.append(F.col(f"`{source}`").alias(field.name))
        else:
            # a number that does not fit is an error; text that is none becomes null
            both = isinstance(df.schema[source].dataType, T.NumericType) and isinstance(field.dataType, T.NumericType)
            c = F.col(f"`{source}`")
            cols.append((c.cast(field.dataType) if both else c.try_cast(field.dataType)).alias(field.name))
    return df.select(*cols)


INVOICE_HEADER = struct(
    "doc_number string, doc_date date, so_number string, customer_code string, customer_name string,"
    " customer_group string, amount money, remamount money, total money,"
    " cost_total money, discount money, doc_stat string, status int, paytrm int,"
    " dlvby string, remark string, bilnum string, sale_area_code string, duedat date"
)
CREDIT_HEADER = struct(
    "doc_number string, doc_date date, so_number string, customer_code string, customer_name string,"
    " customer_group string, amount money, total money, doc_stat string"
)
INVOICE_DETAIL = struct(
    "doc_number string, doc_date date, seqnum int, row_order bigint, stkcod string, stkdes string,"
    " people string, flag string, trnqty money, unit_price money, discount string,"
    " trnval money, cost money, qty_sc_sr_deducted money,"
    " qty_balance money, unit_price_from_sc_sr money"
)
CREDIT_DETAIL = struct(
    "doc_number string, doc_date date, seqnum int, row_order bigint, stkcod string, stkdes string,"
    " people string, flag string, trnqty money, unit_price money, discount string, trnval money, cost money"
)
CASH_LEDGER = struct(
    "docnum string, docdat date, type string, cuscod string, supcod string, chqnum string, trndat date,"
    " bnkacc string, payindat date, net_amt money, date date, chqdat date, remark string,"
    " cmplapp string"
)
BANK_MASTER = struct(
    "bnkacc string, bnknam string, branch string, shortnam string, bnknum string, balfwd money,"
    " baldat date, accnum string, userid string, chgdat date, taxid string, orgnum string"
)
