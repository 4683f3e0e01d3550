"""Order staging and document tracing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates, text


def order_reference_resolve(orders: DataFrame, partners: DataFrame, types: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Partner, order type and warehouse ids of every order; null where a code is unknown. Codes are unique."""
    return (
        orders.join(partners.select(F.col("ref").alias("customer_code"), F.col("id").alias("partner_id")), "customer_code", "left")
        .join(types.select(F.col("name").alias("type_id"), F.col("id").alias("order_type_id"), F.col("warehouse_id").alias("__wh")), "type_id", "left")
        .join(warehouses.select(F.col("id").alias("__wh"), F.col("id").alias("warehouse_id")), "__wh", "left")
        .drop("__wh")
    )


def _order_rejects(resolved: DataFrame) -> DataFrame:
    """One row per reason, all of an order's reasons in one pass."""

    def reason(failed: Column, name: str, value: str) -> Column:
        return F.when(failed, F.struct(F.lit(name).alias("reason"), F.col(value).cast("string").alias("value")))

    reasons = F.array(
        reason(F.col("partner_id").isNull(), "unknown customer", "customer_code"),
        reason(F.col("order_type_id").isNull(), "unknown order type", "type_id"),
        reason(F.col("order_type_id").isNotNull() & F.col("warehouse_id").isNull(), "unknown warehouse", "type_id"),
    )
    return resolved.select("order_no", F.lit(None).cast("int").alias("line_no"), F.explode(F.array_compact(reasons)).alias("r")).select("order_no", "line_no", "r.*")


def order_staging(
    orders: DataFrame, partners: DataFrame, types: DataFrame, warehouses: DataFrame, products: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, lines, rejects) of nested orders.

    Orders with an unknown partner, type or warehouse are rejected whole, lines with an unknown product one by one.
    """
    resolved = order_reference_resolve(orders, partners, types, warehouses)
    complete = F.col("partner_id").isNotNull() & F.col("order_type_id").isNotNull() & F.col("warehouse_id").isNotNull()
    good = resolved.where(complete)
    headers = good.select(
        "order_no",
        "partner_id",
        dates.local_to_utc(F.col("order_date")).alias("date_order"),
        dates.delivery_date(F.col("delivery_date")).alias("delivery_date"),
        "note",
        F.col("order_type_id").alias("type_id"),
        "warehouse_id",
    )
    items = good.select("order_no", F.posexplode("product").alias("at", "item")).select(
        "order_no", (F.col("at") + 1).cast("int").alias("line_no"), text.strip(F.col("item.product_id")).alias("product_code"), "item.width", "item.height", "item.qty"
    )
    known = products.select(F.col("id").cast("string").alias("product_code"), F.col("id").alias("product_id"))
    matched = items.join(known, "product_code", "left")
    lines = matched.where("product_id IS NOT NULL").select("order_no", "line_no", "product_id", "width", "height", F.col("qty").alias("product_uom_qty"))
    unknown = matched.where("product_id IS NULL").select(
        "order_no", "line_no", F.lit("unknown product").alias("reason"), F.col("product_code").cast("string").alias("value")
    )
    rejects = _order_rejects(resolved).unionByName(unknown)
    return headers, lines, rejects


def sheet_orders(sheet_lines: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines with their product variant, rejected lines) of point-of-sale sheets, matched on the product code."""
    known = products.select(F.col("default_code").alias("sku"), F.col("id").alias("product_id"))
    matched = sheet_lines.join(known, "sku", "left")
    return matched.where("product_id IS NOT NULL"), matched.where("product_id IS NULL").drop("product_id")


def order_trace(orders: DataFrame, lines: DataFrame, productions: DataFrame, by: str = "picking") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(order lines, manufacturing orders, orders without any) of sale orders.

    Manufacturing orders are found by picking (incoming_picking in the order's pickings) or by origin (order name).
    """
    line_ids = orders.select(F.col("name").alias("order_name"), F.explode("order_line").alias("line_id"))
    traced_lines = line_ids.join(lines, "line_id")
    if by == "picking":
        links = orders.select(F.col("name").alias("order_name"), F.explode("picking_ids").alias("incoming_picking")).distinct()
        found = links.join(productions, "incoming_picking")
    elif by == "origin":
        found = orders.select(F.col("name").alias("order_name"), F.col("name").alias("origin")).join(productions, "origin")
    else:
        raise ValueError(f"unknown link {by!r}")
    made = found.select("order_name", F.col("id").alias("mo_id"), F.col("name").alias("mo_name"), "product_id", "product_qty", "state")
    without = orders.select(F.col("name").alias("order_name")).join(made.select("order_name").distinct(), "order_name", "left_anti")
    return traced_lines, made, without


def picking_moves(pickings: DataFrame, moves: DataFrame) -> DataFrame:
    """Moves of pickings not yet done, with demand and done quantity."""
    waiting = pickings.where(F.col("state") != "done")
    listed = waiting.select(F.col("name").alias("picking"), F.posexplode("move_lines").alias("position", "move_id"))
    return listed.join(moves, "move_id").select(
        "picking", "position", "move_id", "product_id", "location_id", "product_uom_qty", "quantity_done"
    )


def order_product_trace(productions: DataFrame, templates: DataFrame) -> DataFrame:
    """Manufacturing order -> product template -> category."""
    named = templates.select(F.col("id").alias("product_tmpl_id"), F.col("name").alias("product_name"), F.col("categ_name").alias("category"))
    return productions.select(F.col("name").alias("mo_name"), "product_tmpl_id").join(named, "product_tmpl_id")


def first_line_variant(orders: DataFrame, lines: DataFrame, variants: DataFrame) -> DataFrame:
    """Order -> its first line -> product variant."""
    first = orders.where(F.size("order_line") > 0).select(F.col("name").alias("order_name"), F.element_at("order_line", 1).alias("line_id"))
    return (
        first.join(lines.select("line_id", "product_id", F.col("name").alias("line_name")), "line_id")
        .join(variants.select(F.col("id").alias("product_id")), "product_id")
        .select("order_name", "line_id", "line_name", "product_id")
    )


def delivery_note_trace(notes: DataFrame, invoice_lines: DataFrame) -> DataFrame:
    """Delivery note -> first invoice line -> invoice, partner, order and picking."""
    first = notes.where(F.size("invoice_line_ids") > 0).select(
        F.col("id").alias("note_id"), F.col("name").alias("note_name"), "transport_line", "delivery_mode", "schedule_date", "delivery_date",
        F.element_at("invoice_line_ids", 1).alias("invoice_line_id"),
    )
    return first.join(invoice_lines, "invoice_line_id")
