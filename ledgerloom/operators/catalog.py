"""Product configuration: record snapshots, nested id lists, price tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.operators import filters, ordered
from ledgerloom.schemas import MONEY


def many2one_decode(c: Column) -> tuple[Column, Column]:
    """Raw JSON '[12, "Name"]' -> (12, 'Name'); 'false' -> (null, null)."""
    pair = F.when(c.startswith("["), F.from_json(c, "array<string>"))
    return F.get(pair, F.lit(0)).try_cast("bigint"), F.get(pair, F.lit(1))


def false_to_default(c: Column, default) -> Column:
    """A record field reads false when empty."""
    return F.when(c.isNull() | (c.cast("string") == "false"), F.lit(default)).otherwise(c)


def ids_to_json(c: Column) -> Column:
    """Id list as JSON text, for targets without arrays."""
    return F.to_json(c)


# Snapshot tables: model, then output column -> (record field, kind). Kinds: id / name of a [id, name] pair,
# text, long, double, bool, ids (list), first (first of an id list).
SNAPSHOTS: dict[str, dict[str, tuple[str, str]]] = {
    "products": {
        "product_id": ("id", "long"),
        "name": ("name", "text"),
        "product_cate_id": ("categ_id", "id"),
        "uom": ("uom_id", "name"),
        "width_min": ("width_min", "double"),
        "width_max": ("width_max", "double"),
        "height_min": ("height_min", "double"),
        "height_max": ("height_max", "double"),
        "route_ids": ("route_ids", "ids"),
        "formula_id": ("size_based_on", "id"),
        "formula_name": ("size_based_on", "name"),
        "create_date": ("create_date", "text"),
        "last_update": ("__last_update", "text"),
        "attribute_line": ("attribute_line_ids", "ids"),
    },
    "attribute_lines": {
        "attribute_line_id": ("id", "long"),
        "product_id": ("product_tmpl_id", "id"),
        "attribute_id": ("attribute_id", "id"),
        "attribute_value_ids": ("value_ids", "ids"),
        "default_value_id": ("default_val", "id"),
        "custom": ("custom", "bool"),
    },
    "locations": {"location_id": ("id", "long"), "name": ("name", "text")},
    "attributes": {
        "attribute_id": ("id", "long"),
        "name": ("name", "text"),
        "value_ids": ("value_ids", "ids"),
        "attribute_line": ("attribute_line_ids", "ids"),
    },
    "attribute_values": {
        "attribute_value_id": ("id", "long"),
        "name": ("name", "text"),
        "attribute_id": ("attribute_id", "id"),
        "combo_id": ("related_product_id", "first"),
    },
    "default_values": {
        "default_id": ("id", "long"),
        "product_id": ("product_category", "id"),
        "attribute_value_id": ("attribute_value_id", "id"),
        "default_attribute_value_id": ("default_attribute_ids", "ids"),
    },
    "formulas": {
        "formula_id": ("id", "long"),
        "formula_name": ("name", "text"),
        "price_based": ("price_based", "text"),
        "uom": ("uom_id", "name"),
        "formula_type": ("compute_price", "text"),
        "dimension": ("dimension", "text"),
        "code": ("code_py1", "text"),
    },
    "pricelist_items": {
        "pricelist_line_id": ("id", "long"),
        "product_id": ("product_tmpl_id", "id"),
        "product_name": ("product_tmpl_id", "name"),
        "pricelist_id": ("pricelist_id", "id"),
        "pricelist_name": ("pricelist_id", "name"),
        "compute_price": ("compute_price", "text"),
        "fixed_price": ("fixed_price", "double"),
        "price_discount": ("price_discount", "double"),
        "formula_price": ("percent_price_text", "text"),
    },
    "pricelist_types": {
        "pricelist_id": ("id", "long"),
        "pricelist_name": ("name", "text"),
        "discount_policy": ("discount_policy", "text"),
        "display_pricelist": ("display_pricelist", "text"),
    },
    "variant_values": {
        "variant_line_id": ("id", "long"),
        "product_id": ("product_tmpl_id", "id"),
        "product_name": ("product_tmpl_id", "name"),
        "product_cate_id": ("categ_id", "id"),
        "attribute_line_id": ("attribute_line_id", "id"),
        "attribute_id": ("attribute_id", "id"),
        "attribute_value_id": ("product_attribute_value_id", "id"),
        "attribute_size_extra": ("attribute_size_extra", "double"),
        "price_extra": ("price_extra", "double"),
        "formula_id": ("size_based_on", "id"),
        "formula_name": ("size_based_on", "name"),
        "uom": ("size_based_on_uom_id", "name"),
        "cash_price": ("cash_price", "double"),
        "credit_price": ("credit_price", "double"),
        "modern_trade_price": ("modern_trade", "double"),
        "customer_price": ("customer_price", "double"),
        "online_price": ("online_price", "double"),
        "discount_cash_price": ("discount_cash_price", "double"),
        "discount_credit_price": ("discount_credit_price", "double"),
        "discount_modern_trade_price": ("discount_modern_trade", "double"),
        "discount_customer_price": ("discount_customer_price", "double"),
        "discount_online_price": ("discount_online_price", "double"),
    },
    "caught_groups": {
        "categ_caught_id": ("id", "long"),
        "categ_caught_name": ("name", "text"),
        "display_name": ("display_name", "text"),
    },
    "caught_rates": {
        "id": ("id", "long"),
        "name": ("name", "text"),
        "categ_caught_id": ("categ_caught_id", "id"),
        "categ_caught_name": ("categ_caught_id", "name"),
        "min": ("min", "double"),
        "max": ("max", "double"),
        "qty": ("qty", "double"),
        "active": ("active", "bool"),
    },
    **{
        table: {
            "id": ("id", "long"),
            "product_id": ("product_tmpl_id", "id"),
            "product_name": ("product_tmpl_id", "name"),
            "name": ("name", "text"),
            "price": ("price", "double"),
            "set_default": ("set_default", "bool"),
            "formula_id": ("formula", "id"),
        }
        for table in ("caught_prices", "switch_prices", "remote_prices")
    },
    "categories": {
        "display_name": ("complete_name", "text"),
        "name": ("name", "text"),
        "parent_category": ("parent_id", "name"),
        "erp_id": ("id", "long"),
    },
    "erp_products": {
        "stkcod": ("default_code", "text"),
        "barcod": ("barcode", "text"),
        "names": ("name", "text"),
        "stkdes": ("display_name", "text"),
        "qucod": ("uom_id", "id"),
        "sellpr1": ("list_price", "double"),
        "category": ("categ_id", "name"),
    },
    "uoms": {
        "ID": ("id", "long"),
        "UnitofMeasure": ("name", "text"),
        "Category": ("category_id", "name"),
        "Type": ("uom_type", "text"),
    },
    "saved_filters": {
        "id": ("id", "long"),
        "name": ("name", "text"),
        "domain": ("domain", "text"),
        "context": ("context", "text"),
        "sort": ("sort", "text"),
        "model_id": ("model_id", "text"),
        "is_default": ("is_default", "bool"),
        "action_id": ("action_id", "name"),
        "active": ("active", "bool"),
        "create_uid": ("create_uid", "id"),
        "write_uid": ("write_uid", "id"),
        "user_id": ("user_id", "name"),
    },
}

# The 15 tables of the product-configuration mirror.
CONFIG_TABLES = tuple(t for t in SNAPSHOTS if t not in ("erp_products", "uoms", "saved_filters"))
_RAW = {"id": "string", "name": "string", "text": "string", "long": "bigint", "double": "double", "bool": "boolean",
        "ids": "array<bigint>", "first": "string"}


def raw_schema(table: str) -> str:
    """Schema to read the JSON records with: [id, name] pairs and false stay raw text."""
    fields = {f: _RAW[kind] for f, kind in SNAPSHOTS[table].values()}
    return ", ".join(f"`{f}` {kind}" for f, kind in fields.items())


def _typed(field: str, kind: str) -> Column:
    c = F.col(f"`{field}`")
    if kind == "id":
        return many2one_decode(c)[0]
    if kind == "name":
        return many2one_decode(c)[1]
    if kind == "first":
        return F.get(F.from_json(F.when(c.startswith("["), c), "array<string>"), F.lit(0)).try_cast("bigint")
    if kind == "text":
        return F.nullif(c, F.lit("false"))
    return c


def config_snapshot(raw: DataFrame, table: str, category_paths: Sequence[str] = ()) -> DataFrame:
    """Typed table of a model's records; category_paths keeps records whose category name contains one of them."""
    out = raw
    if category_paths:
        category = many2one_decode(F.col("categ_id"))[1]
        out = out.withColumn("__category", category)
        out = out.where(filters.any_of(*[("__category", "ilike", p) for p in category_paths]))
    return out.select(*[_typed(f, kind).alias(name) for name, (f, kind) in SNAPSHOTS[table].items()])


def product_config_snapshot(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All mirror tables for which records are given."""
    return {t: config_snapshot(raw[t], t) for t in CONFIG_TABLES if t in raw}


def variant_price_table(raw: DataFrame, category_paths: Sequence[str] = ()) -> DataFrame:
    return config_snapshot(raw, "variant_values", category_paths)


def category_hierarchy(raw: DataFrame) -> DataFrame:
    return config_snapshot(raw, "categories")


def erp_product_snapshot(raw: DataFrame) -> DataFrame:
    """Products with a code: empty fields as '' or 0, the category path cut into first and last part."""
    typed = config_snapshot(raw, "erp_products").where(F.col("stkcod").isNotNull())
    first, last = text.category_path_split(F.col("category"))
    return typed.select(
        "stkcod",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("barcod", "names", "stkdes")],
        F.coalesce("qucod", F.lit(0)).cast("bigint").alias("qucod"),
        F.coalesce("sellpr1", F.lit(0)).cast(MONEY).alias("sellpr1"),
        first.alias("acccod"),
        last.alias("stkgrp"),
    )


def uom_snapshot(raw: DataFrame) -> DataFrame:
    typed = config_snapshot(raw, "uoms")
    return typed.select("ID", *[F.coalesce(text.strip(F.col(c)), F.lit("")).alias(c) for c in ("UnitofMeasure", "Category", "Type")])


def saved_filter_snapshot(raw: DataFrame) -> DataFrame:
    return config_snapshot(raw, "saved_filters").orderBy("id")


def duplicate_list_ids(products: DataFrame, key: str = "product_id", ids: str = "attribute_line") -> DataFrame:
    """(product, id, occurrences) of ids listed more than once; the list is one cell, so this stays in the row."""
    seen = F.array_distinct(ids)
    counted = F.transform(
        seen, lambda i: F.struct(i.alias("id"), F.size(F.filter(F.col(ids), lambda x: x == i)).cast("bigint").alias("occurrences"))
    )
    repeated = F.filter(counted, lambda s: s["occurrences"] > 1)
    suspicious = products.where(F.size(seen) < F.size(ids))
    return suspicious.select(key, F.explode(repeated).alias("dup")).select(key, "dup.*")


def attribute_line_explode(products: DataFrame, lines: DataFrame, key: str = "product_id", ids: str = "attribute_line") -> DataFrame:
    """Attribute lines of the products, skipping products that list an id twice."""
    clean = products.where(F.size(F.array_distinct(ids)) == F.size(ids))
    listed = clean.select(F.explode(ids).alias("attribute_line_id"))
    return listed.join(lines, "attribute_line_id")


def related_product_chain(values: DataFrame, combos: DataFrame, variants: DataFrame) -> DataFrame:
    """Attribute value -> combo option -> product variant -> template id; null where a link is absent."""
    to_variant = combos.select(F.col("id").alias("combo_id"), F.col("product_id").alias("__variant"))
    to_template = variants.select(F.col("id").alias("__variant"), F.col("product_tmpl_id").alias("related_product_id"))
    return (
        values.join(to_variant, "combo_id", "left")
        .join(to_template, "__variant", "left")
        .select("attribute_value_id", "name", "attribute_id", "related_product_id")
    )


def variant_by_attribute_set(variants: DataFrame, ids: Sequence[int], col: str = "attribute_value_ids") -> DataFrame:
    """Variants holding every one of the given attribute values."""
    wanted = F.array(*[F.lit(int(i)).cast("bigint") for i in ids])
    return variants.where(F.size(F.array_except(wanted, col)) == 0)


def variant_attribute_pairs(variants: DataFrame, values: DataFrame, key: str = "variant_id", ids: str = "attribute_value_ids") -> DataFrame:
    """(variant, position, 'attribute:value'), in list order."""
    listed = variants.select(key, F.posexplode(ids).alias("position", "attribute_value_id"))
    pair = F.concat(F.col("attribute_name"), F.lit(":"), F.col("name")).alias("pair")
    return listed.join(values, "attribute_value_id").select(key, "position", pair)


# fabric products: source column -> table column
FABRIC_COLUMNS = {
    "RefCode": "ref_code", "RefValue": "ref_value", "RefDescription": "ref_description", "UnitUOM": "unit_uom", "Width": "width",
    "WidthTxt": "width_txt", "WidthUOM": "width_uom", "PriceOut": "price_out", "Price": "price", "PriceRate1": "price_rate1",
    "PriceRate2": "price_rate2", "Discount1": "discount1", "Discount2": "discount2", "HPrice": "h_price", "HDiscount": "h_discount",
    "smBal": "sm_bal", "smReserve": "sm_reserve", "smScrab": "sm_scrab", "composition": "composition", "Owner": "owner",
    "FlagDelete": "flag_delete",
}
DEFAULT_CATEGORY = 8


def fabric_clean(raw: DataFrame) -> DataFrame:
    """Text free of control characters, trimmed, '' as null, one leading Thai letter off the code; numbers null -> 0."""
    cols = []
    for source, name in FABRIC_COLUMNS.items():
        c = F.col(source)
        if raw.schema[source].dataType.simpleString() == "string":
            c = text.control_char_strip(c)
            if source == "RefCode":
                c = text.leading_thai_strip(c)
            c = text.blank_to_null(c, ("", "nan", "None"))
        else:
            c = F.coalesce(c, F.lit(0).cast(raw.schema[source].dataType))
        cols.append(c.alias(name))
    return raw.select(*cols).where(F.col("ref_code").isNotNull())


def fabric_product_load(
    raw: DataFrame,
    existing: DataFrame,
    category_match: DataFrame,
    categories: DataFrame,
    run_ts: dt.datetime,
    first_load: bool,
    order: Sequence[str] = ("ref_value",),
) -> DataFrame:
    """Table state after the load. First load: category by name match (default 8), everything active.

    Later loads keep category and active of known products. A known product goes inactive when the incoming
    flag_delete is 0. Unlisted products stay. Of a repeated code the first row along `order` counts.
    """
    stamp = F.lit(run_ts.isoformat(" ")).cast("timestamp_ntz")
    incoming = ordered.first_per_key(fabric_clean(raw), ["ref_code"], order)
    if first_load:
        named = category_match.join(
            categories.select(F.col("id").alias("__cat"), F.col("name").alias("category_name")), "category_name"
        ).groupBy("ref_code").agg(F.min("__cat").alias("__cat"))
        incoming = incoming.join(named, "ref_code", "left")
    else:
        incoming = incoming.withColumn("__cat", F.lit(None).cast("int"))
    data_cols = [c for c in FABRIC_COLUMNS.values() if c != "ref_code"]
    new = incoming.select("ref_code", F.struct("__cat", *data_cols).alias("__new"))
    both = existing.withColumn("__old", F.lit(True)).join(new, "ref_code", "full_outer")
    is_new, known = F.col("__new").isNotNull(), F.coalesce("__old", F.lit(False))
    kept_category = F.col("__new.__cat") if first_load else F.col("product_category_id")
    kept_active = F.lit(1) if first_load else F.coalesce("active", F.lit(1))
    active = F.when(known & (F.col("__new.flag_delete") == 0), F.lit(0)).otherwise(kept_active)
    return both.select(
        "ref_code",
        *[F.when(is_new, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in data_cols],
        F.when(is_new, F.coalesce(kept_category, F.lit(DEFAULT_CATEGORY))).otherwise(F.col("product_category_id")).cast("int").alias("product_category_id"),
        F.when(is_new, active).otherwise(F.col("active")).cast("int").alias("active"),
        F.when(known, F.col("created_at")).otherwise(stamp).alias("created_at"),
        F.when(is_new, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def swap_names(df: DataFrame, first: str = "firstname", last: str = "lastname") -> DataFrame:
    """The contents of two columns exchanged, all columns in their places."""
    other = {first: last, last: first}
    return df.select(*[F.col(f"`{other.get(c, c)}`").alias(c) for c in df.columns])
