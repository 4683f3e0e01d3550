"""Catalog, order, trace, page and calendar queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators import calendar, catalog, matching, orders, pages
from ledgerloom.plans import adapters as ad
from ledgerloom.plans import sqlparts as q
from ledgerloom.plans.q_sources import _json, _pair, _quoted, product_records
from ledgerloom.plans.registry import query
from ledgerloom.schemas import MONEY


def _parsed(df: DataFrame, record, table: str) -> DataFrame:
    """JSON records held in a column, read with the schema of the model."""
    return df.select(F.from_json(record, catalog.raw_schema(table)).alias("r")).select("r.*")


def _products(spark, sf) -> DataFrame:
    return catalog.config_snapshot(_parsed(*product_records(spark, sf), "products"), "products")


_PARTS = """parts AS (SELECT p_partkey AS product_id, [p_partkey * 3, p_partkey * 3 + 1] ||
    CASE WHEN p_partkey % 10 = 0 THEN [p_partkey * 3] ELSE [] END AS attribute_line FROM part)"""


@query("many2one_decode", "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % 5 END AS uom_id, CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS uom_name FROM part")
def many2one_decode(spark, sf):
    k = F.col("p_partkey")
    raw = F.when(k % 4 == 0, F.lit("false")).otherwise(_pair(k % 5, F.col("p_type")))
    number, name = catalog.many2one_decode(raw)
    return ad.table(spark, sf, "part").select(k, number.alias("uom_id"), name.alias("uom_name"))


@query(
    "false_to_default",
    "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS name, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_size END AS size FROM part",
)
def false_to_default(spark, sf):
    k = F.col("p_partkey")
    name = F.when(k % 8 == 0, F.lit("false")).when(k % 4 != 0, F.col("p_name"))
    size = F.when(k % 3 != 0, F.col("p_size"))
    return ad.table(spark, sf, "part").select(
        k, catalog.false_to_default(name, "").alias("name"), catalog.false_to_default(size, 0).alias("size")
    )


@query("ids_to_json", f"WITH {_PARTS} SELECT product_id, '[' || array_to_string(attribute_line, ',') || ']' AS ids FROM parts")
def ids_to_json(spark, sf):
    return _products(spark, sf).select("product_id", catalog.ids_to_json(F.col("attribute_line")).alias("ids"))


@query(
    "duplicate_list_ids",
    f"WITH {_PARTS} SELECT product_id, id, count(*) AS occurrences FROM (SELECT product_id, unnest(attribute_line) AS id FROM parts) GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_list_ids(spark, sf):
    return catalog.duplicate_list_ids(_products(spark, sf))


def _attribute_lines(spark, sf) -> DataFrame:
    """Attribute lines 3k and 3k + 1 of every product k."""
    p = ad.table(spark, sf, "part")
    k, line = F.col("p_partkey"), F.col("line")
    doubled = p.select(k, F.col("p_type"), F.explode(F.array(k * 3, k * 3 + 1)).alias("line"))
    record = _json(
        id=line.cast("string"),
        product_tmpl_id=_pair(k, F.lit("p")),
        attribute_id=_pair(line % 9, F.lit("attribute")),
        value_ids=F.concat(F.lit("["), (line % 50).cast("string"), F.lit(", "), (line % 70).cast("string"), F.lit("]")),
        default_val=F.when(line % 2 == 0, F.lit("false")).otherwise(_pair(line % 50, F.lit("value"))),
        custom=F.when(line % 3 == 0, F.lit("true")).otherwise(F.lit("false")),
    )
    return catalog.config_snapshot(_parsed(doubled, record, "attribute_lines"), "attribute_lines")


@query(
    "attribute_line_explode",
    """SELECT line AS attribute_line_id, p_partkey AS product_id, line % 9 AS attribute_id, '[' || CAST(line % 50 AS VARCHAR) || ',' || CAST(line % 70 AS VARCHAR) || ']' AS value_ids,
    CASE WHEN line % 2 <> 0 THEN line % 50 END AS default_value_id, line % 3 = 0 AS custom
    FROM (SELECT p_partkey, unnest([p_partkey * 3, p_partkey * 3 + 1]) AS line FROM part WHERE p_partkey % 10 <> 0)""",
)
def attribute_line_explode(spark, sf):
    out = catalog.attribute_line_explode(_products(spark, sf).select("product_id", "attribute_line"), _attribute_lines(spark, sf))
    return out.withColumn("value_ids", catalog.ids_to_json(F.col("attribute_value_ids"))).drop("attribute_value_ids")


def _named_records(spark, sf, table: str) -> tuple[DataFrame, object]:
    """Records of a model with one row per part: ids from the key, names, pairs, prices."""
    p = ad.table(spark, sf, "part")
    k = F.col("p_partkey")
    values = {
        "string": {
            "id": lambda f: F.when(k % 4 == 0, F.lit("false")).otherwise(_pair(k % 50, F.lit(f))),
            "name": lambda f: F.when(k % 4 == 0, F.lit("false")).otherwise(_pair(k % 50, F.lit(f))),
            "text": lambda f: F.when(k % 6 == 0, F.lit("false")).otherwise(_quoted(F.concat(F.lit(f + " "), k.cast("string")))),
            "first": lambda f: F.when(k % 5 == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), (k % 40).cast("string"), F.lit(', "combo"]'))),
        },
    }["string"]
    fields = {}
    for f, kind in catalog.SNAPSHOTS[table].values():
        if kind in values:
            fields[f] = values[kind](f)
        elif kind == "long":
            fields[f] = k.cast("string")
        elif kind == "double":
            fields[f] = F.concat((k % 100).cast("string"), F.lit(".25"))
        elif kind == "bool":
            fields[f] = F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false"))
        else:
            fields[f] = F.concat(F.lit("["), k.cast("string"), F.lit("]"))
    return p, _json(**fields)


def _snapshot(spark, sf, table: str) -> DataFrame:
    return _parsed(*_named_records(spark, sf, table), table)


def _snapshot_sql(table: str) -> str:
    cols = []
    for name, (f, kind) in catalog.SNAPSHOTS[table].items():
        cols.append(
            {
                "id": "CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % 50 END",
                "name": f"CASE WHEN p_partkey % 4 <> 0 THEN '{f}' END",
                "text": f"CASE WHEN p_partkey % 6 <> 0 THEN '{f} ' || CAST(p_partkey AS VARCHAR) END",
                "first": "CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 40 END",
                "long": "p_partkey",
                "double": "CAST(p_partkey % 100 AS DOUBLE) + 0.25",
                "bool": "p_partkey % 2 = 0",
                "ids": "[p_partkey]",
            }[kind]
            + f' AS "{name}"'
        )
    return f"SELECT {', '.join(cols)} FROM part"


@query(
    "product_config_snapshot",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS records, CAST(count({", ".join(['"' + c + '"']) }) AS BIGINT) AS filled, '{c}' AS column_name FROM ({_snapshot_sql(t)})"""
        for t in catalog.CONFIG_TABLES
        for c in catalog.SNAPSHOTS[t]
    ),
)
def product_config_snapshot(spark, sf):
    """Records and filled cells of every column of the 15 mirror tables."""
    tables = catalog.product_config_snapshot({t: _snapshot(spark, sf, t) for t in catalog.CONFIG_TABLES})
    out = None
    for name, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("records"), *[F.count(f"`{c}`").alias(c) for c in df.columns if c != "records"])
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("filled")) for c in df.columns])
        rows = counts.select(F.lit(name).alias("table_name"), "records", F.explode(cells).alias("cell")).select("table_name", "records", "cell.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def _cells_sql(table: str) -> str:
    texts = " || ',' || ".join(f"""coalesce(CAST("{c}" AS VARCHAR), '-')""" for c in catalog.SNAPSHOTS[table])
    return f"""SELECT '{table}' AS table_name, '{",".join(catalog.SNAPSHOTS[table])}' AS column_names, {texts} AS cells FROM ({_snapshot_sql(table)})"""


@query("product_config_snapshot_values", " UNION ALL ".join(_cells_sql(t) for t in catalog.CONFIG_TABLES))
def product_config_snapshot_values(spark, sf):
    """Every record of the 15 mirror tables with the values of all its cells."""
    out = None
    for name, df in catalog.product_config_snapshot({t: _snapshot(spark, sf, t) for t in catalog.CONFIG_TABLES}).items():
        texts = [F.to_json(c) if df.schema[c].dataType.simpleString().startswith("array") else F.col(f"`{c}`").cast("string") for c in df.columns]
        cells = F.concat_ws(",", *[F.coalesce(t, F.lit("-")) for t in texts])
        rows = df.select(F.lit(name).alias("table_name"), F.lit(",".join(df.columns)).alias("column_names"), cells.alias("cells"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("variant_price_table", _snapshot_sql("variant_values"))
def variant_price_table(spark, sf):
    return catalog.variant_price_table(_snapshot(spark, sf, "variant_values"))


@query("category_hierarchy", _snapshot_sql("categories"))
def category_hierarchy(spark, sf):
    return catalog.category_hierarchy(_snapshot(spark, sf, "categories"))


@query(
    "erp_product_snapshot",
    f"""SELECT 'C' || CAST(p_partkey AS VARCHAR) AS stkcod, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END AS barcod, p_name AS names, p_name AS stkdes,
    CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_partkey % 5 END AS qucod, CAST(p_retailprice AS {q.M}) AS sellpr1, 'All ' AS acccod, p_type AS stkgrp FROM part WHERE p_partkey % 6 <> 0""",
)
def erp_product_snapshot(spark, sf):
    k = F.col("p_partkey")
    record = _json(
        default_code=F.when(k % 6 == 0, F.lit("false")).otherwise(_quoted(F.concat(F.lit("C"), k.cast("string")))),
        barcode=F.when(k % 4 == 0, F.lit("false")).otherwise(_quoted(F.col("p_brand"))),
        name=_quoted(F.col("p_name")),
        display_name=_quoted(F.col("p_name")),
        uom_id=F.when(k % 5 == 0, F.lit("false")).otherwise(_pair(k % 5, F.lit("unit"))),
        list_price=F.col("p_retailprice").cast(MONEY).cast("string"),
        categ_id=_pair(F.col("p_size"), F.concat(F.lit("All / Goods / "), F.col("p_type"))),
    )
    return catalog.erp_product_snapshot(_parsed(ad.table(spark, sf, "part"), record, "erp_products"))


@query(
    "uom_snapshot",
    """SELECT p_partkey AS "ID", CASE WHEN p_partkey % 6 <> 0 THEN 'name ' || CAST(p_partkey AS VARCHAR) ELSE '' END AS "UnitofMeasure",
    CASE WHEN p_partkey % 4 <> 0 THEN 'category_id' ELSE '' END AS "Category", CASE WHEN p_partkey % 6 <> 0 THEN 'uom_type ' || CAST(p_partkey AS VARCHAR) ELSE '' END AS "Type" FROM part""",
)
def uom_snapshot(spark, sf):
    return catalog.uom_snapshot(_snapshot(spark, sf, "uoms"))


@query("saved_filter_snapshot", _snapshot_sql("saved_filters"))
def saved_filter_snapshot(spark, sf):
    return catalog.saved_filter_snapshot(_snapshot(spark, sf, "saved_filters"))


@query(
    "related_product_chain",
    """SELECT p_partkey AS attribute_value_id, CASE WHEN p_partkey % 6 <> 0 THEN 'name ' || CAST(p_partkey AS VARCHAR) END AS name,
    CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % 50 END AS attribute_id,
    CASE WHEN p_partkey % 5 <> 0 AND (p_partkey % 40) % 2 = 0 THEN (p_partkey % 40) * 10 + 7 END AS related_product_id FROM part""",
)
def related_product_chain(spark, sf):
    values = catalog.config_snapshot(_snapshot(spark, sf, "attribute_values"), "attribute_values")
    p = ad.table(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    combos = p.select(F.col("k").alias("id"), (F.col("k") + 1000).alias("product_id"))
    variants = p.select(F.when(F.col("k") % 2 == 0, F.col("k") + 1000).otherwise(-1 - F.col("k")).alias("id"), (F.col("k") * 10 + 7).alias("product_tmpl_id"))
    return catalog.related_product_chain(values, combos, variants)


def _variants(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    return ad.table(spark, sf, "part").select(k.alias("variant_id"), F.array(k % 5, k % 7 + 10, k % 3 + 20).alias("attribute_value_ids"))


@query("variant_by_attribute_set", "SELECT p_partkey AS variant_id FROM part WHERE p_partkey % 5 = 3 AND p_partkey % 7 + 10 = 12 AND p_partkey % 3 + 20 = 21")
def variant_by_attribute_set(spark, sf):
    return catalog.variant_by_attribute_set(_variants(spark, sf), [3, 12, 21]).select("variant_id")


@query(
    "variant_attribute_pairs",
    """SELECT p_partkey AS variant_id, CAST(i AS INTEGER) AS position, CASE i WHEN 0 THEN 'R0:' ELSE 'R' || CAST(v % 5 AS VARCHAR) || ':' END || 'NATION_' || CAST(v AS VARCHAR) AS pair
    FROM (SELECT p_partkey, unnest([0, 1, 2]) AS i, unnest([p_partkey % 5, p_partkey % 7 + 10, p_partkey % 3 + 20]) AS v FROM part)""".replace(
        "CASE i WHEN 0 THEN 'R0:' ELSE 'R' || CAST(v % 5 AS VARCHAR) || ':' END", "'R' || CAST(v % 5 AS VARCHAR) || ':'"
    ),
)
def variant_attribute_pairs(spark, sf):
    n = ad.table(spark, sf, "nation")
    values = n.select(
        F.col("n_nationkey").cast("bigint").alias("attribute_value_id"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("attribute_name"),
        F.col("n_name").alias("name"),
    )
    return catalog.variant_attribute_pairs(_variants(spark, sf), values)


HEIGHTS = [0.5 + 0.1 * i for i in range(26)]
WIDTHS = [0.5 + 0.1 * i for i in range(33)]


@query(
    "price_surface_lookup",
    f"""WITH probes AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity / 12 AS DECIMAL(15,4)) AS width, CAST(l_suppkey % 40 + 1 AS DECIMAL(15,4)) / 10 AS hh FROM lineitem),
    probes2 AS (SELECT * EXCLUDE (hh), CAST(hh AS DECIMAL(15,4)) AS height FROM probes),
    grid AS (SELECT *, least(greatest(CAST(ceil((height - 0.5) * 10) AS INTEGER), 0), 25) AS hi, least(greatest(CAST(ceil((width - 0.5) * 10) AS INTEGER), 0), 32) AS wi FROM probes2)
    SELECT l_orderkey, l_linenumber, l_partkey, width, height, CAST(0.5 + hi * 0.1 AS DECIMAL(5,2)) AS grid_height, CAST(0.5 + wi * 0.1 AS DECIMAL(5,2)) AS grid_width,
      CAST(1000 + hi * 40 + wi * 25 AS {q.M}) AS price FROM grid""",
)
def price_surface_lookup(spark, sf):
    li = ad.table(spark, sf, "lineitem")
    probes = li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_quantity") / 12).cast("decimal(15,4)").alias("width"),
        ((F.col("l_suppkey") % 40 + 1).cast("decimal(15,4)") / 10).cast("decimal(15,4)").alias("height"),
    )
    # one formula price per grid point
    grid = [(f"{h:.2f}", f"{w:.2f}", 1000 + i * 40 + j * 25) for i, h in enumerate(HEIGHTS) for j, w in enumerate(WIDTHS)]
    surface = spark.createDataFrame(grid, "height string, width string, price int")
    return matching.price_surface_lookup(probes, surface, HEIGHTS, WIDTHS)


@query(
    "contains_lookup",
    """WITH needles AS (SELECT DISTINCT CASE WHEN n_nationkey % 2 = 0 THEN '#' || CAST(n_nationkey AS VARCHAR) ELSE 'red ' || chr(CAST(97 + n_nationkey AS INTEGER)) END AS needle FROM nation)
    SELECT needle, p_partkey, code FROM needles JOIN (SELECT p_partkey, upper(p_name) || ' ' || p_brand AS code FROM part) ON contains(lower(code), lower(needle))""",
)
def contains_lookup(spark, sf):
    k = F.col("n_nationkey")
    needles = ad.table(spark, sf, "nation").select(
        F.when(k % 2 == 0, F.concat(F.lit(" #"), k.cast("string"), F.lit(" "))).otherwise(F.concat(F.lit("Red "), F.char(F.lit(97) + k))).alias("needle")
    )
    products = ad.table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", F.upper("p_name"), F.col("p_brand")).alias("code"))
    out = matching.contains_lookup(needles, "needle", products, "code")
    return out.withColumn("needle", F.regexp_replace("needle", "^Red ", "red "))


@query(
    "priority_map_update",
    """SELECT p.p_partkey AS id, coalesce(u.priority, p.p_size) AS priority FROM part p LEFT JOIN
    (SELECT o_orderkey % 3000 AS id, arg_max(CAST(o_custkey % 90 AS INTEGER), o_orderkey) AS priority FROM orders GROUP BY 1) u ON p.p_partkey = u.id""",
)
def priority_map_update(spark, sf):
    o = ad.table(spark, sf, "orders")
    updates = o.select(
        F.concat(F.lit(" "), (F.col("o_orderkey") % 3000).cast("string")).alias("name"),
        F.concat((F.col("o_custkey") % 90).cast("string"), F.lit(" ")).alias("priority"),
        F.col("o_orderkey").alias("line_no"),
    )
    products = ad.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("priority"))
    return matching.priority_map_update(products, updates.withColumnRenamed("priority", "new_priority"), "id", "name", "new_priority", "line_no")


# ---- orders and traces ----


def _requests(spark, sf) -> DataFrame:
    """Order requests with one or two products; some codes are unknown."""
    o = ad.table(spark, sf, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    item = lambda code, qty: F.struct(
        code.alias("product_id"), F.lit(1.5).alias("width"), (k % 4 + 1).cast("double").alias("height"), qty.cast("int").alias("qty")
    )
    first = item(F.concat((k % 2500).cast("string"), F.lit("\t")), k % 9 + 1)
    second = item((k % 700).cast("string"), F.lit(2))
    return o.select(
        k.alias("order_no"),
        F.when(k % 17 == 0, F.lit("9-99-x")).otherwise(ad.customer_code(c)).alias("customer_code"),
        ad.pick(["Normal Order", "Urgent Order", "No Warehouse", "Unknown"], F.least(k % 40, F.lit(3))).alias("type_id"),
        F.date_format("o_orderdate", "dd/MM/yyyy 05:00:00").alias("order_date"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("delivery_date"),
        F.col("o_orderpriority").alias("note"),
        F.when(k % 2 == 0, F.array(first)).otherwise(F.array(first, second)).alias("product"),
    ).withColumn("type_id", F.when(F.col("order_no") % 40 >= 3, F.when(F.col("order_no") % 13 == 5, F.lit("Unknown")).otherwise(F.lit("Normal Order"))).otherwise(F.col("type_id")))


def _references(spark, sf):
    c = ad.table(spark, sf, "customer")
    partners = c.select(ad.customer_code(F.col("c_custkey")).alias("ref"), (F.col("c_custkey") + 50000).alias("id"))
    r = ad.table(spark, sf, "region")
    types = r.select(
        ad.pick(["Normal Order", "Urgent Order", "No Warehouse", "Spare 3", "Spare 4"], F.col("r_regionkey")).alias("name"),
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"),
        (F.col("r_regionkey") + 10).cast("bigint").alias("warehouse_id"),
    )
    key = F.col("r_regionkey")
    warehouses = r.select(F.when(key < 2, key + 10).otherwise(key + 100).cast("bigint").alias("id"))
    products = ad.table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    return partners, types, warehouses, products


_REQ = f"""req AS (SELECT o_orderkey AS order_no, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE c_custkey + 50000 END AS partner_id,
    CASE WHEN o_orderkey % 17 = 0 THEN '9-99-x' ELSE {q.code('o_custkey')} END AS customer_code,
    CASE o_orderkey % 40 WHEN 0 THEN 'Normal Order' WHEN 1 THEN 'Urgent Order' WHEN 2 THEN 'No Warehouse' ELSE CASE WHEN o_orderkey % 13 = 5 THEN 'Unknown' ELSE 'Normal Order' END END AS type_name,
    o_orderdate, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey),
  res AS (SELECT *, CASE type_name WHEN 'Normal Order' THEN 1 WHEN 'Urgent Order' THEN 2 WHEN 'No Warehouse' THEN 3 END AS tid,
    CASE type_name WHEN 'Normal Order' THEN 10 WHEN 'Urgent Order' THEN 11 END AS wid FROM req),
  items AS (SELECT order_no, partner_id, wid, CAST(unnest([1, 2]) AS INTEGER) AS line_no, unnest([order_no % 2500, order_no % 700]) AS code FROM res),
  known_items AS (SELECT i.*, p.p_partkey FROM items i LEFT JOIN part p ON p.p_partkey = i.code WHERE (line_no = 1 OR order_no % 2 = 1) AND partner_id IS NOT NULL AND wid IS NOT NULL)"""


def _staged(spark, sf):
    return orders.order_staging(_requests(spark, sf), *_references(spark, sf))


@query(
    "order_staging",
    f"""WITH {_REQ} SELECT order_no, partner_id, CAST(o_orderdate AS TIMESTAMP) - INTERVAL 2 HOUR AS date_order, CAST(o_orderdate AS DATE) AS delivery_date,
    o_orderpriority AS note, CAST(tid AS BIGINT) AS type_id, CAST(wid AS BIGINT) AS warehouse_id FROM res WHERE partner_id IS NOT NULL AND wid IS NOT NULL""",
)
def order_staging(spark, sf):
    return _staged(spark, sf)[0]


@query(
    "order_staging_lines",
    f"""WITH {_REQ} SELECT order_no, line_no, p_partkey AS product_id, 1.5::DOUBLE AS width, CAST(order_no % 4 + 1 AS DOUBLE) AS height,
    CAST(CASE WHEN line_no = 1 THEN order_no % 9 + 1 ELSE 2 END AS INTEGER) AS product_uom_qty FROM known_items WHERE p_partkey IS NOT NULL""",
)
def order_staging_lines(spark, sf):
    return _staged(spark, sf)[1]


@query(
    "order_staging_rejects",
    f"""WITH {_REQ} SELECT order_no, CAST(NULL AS INTEGER) AS line_no, 'unknown customer' AS reason, customer_code AS value FROM res WHERE partner_id IS NULL
    UNION ALL SELECT order_no, NULL, 'unknown order type', type_name FROM res WHERE tid IS NULL
    UNION ALL SELECT order_no, NULL, 'unknown warehouse', type_name FROM res WHERE tid IS NOT NULL AND wid IS NULL
    UNION ALL SELECT order_no, line_no, 'unknown product', CAST(code AS VARCHAR) FROM known_items WHERE p_partkey IS NULL""",
)
def order_staging_rejects(spark, sf):
    return _staged(spark, sf)[2]


@query(
    "order_reference_resolve",
    f"WITH {_REQ} SELECT order_no, partner_id, CAST(tid AS BIGINT) AS order_type_id, CAST(wid AS BIGINT) AS warehouse_id FROM res",
)
def order_reference_resolve(spark, sf):
    partners, types, warehouses, _ = _references(spark, sf)
    out = orders.order_reference_resolve(_requests(spark, sf), partners, types, warehouses)
    return out.select("order_no", "partner_id", "order_type_id", "warehouse_id")


def _sale_orders(spark, sf):
    """(orders with line and picking ids, order lines, manufacturing orders)."""
    o = ad.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("SO"), k.cast("string"))
    sale = o.select(k.alias("id"), name.alias("name"), F.array(k * 2, k * 2 + 1).alias("order_line"), F.when(k % 2 == 0, F.array(k)).otherwise(F.array(k, k + 500000)).alias("picking_ids"))
    lines = o.select(F.explode(F.array(k * 2, k * 2 + 1)).alias("line_id"), (F.col("o_custkey") % 100).alias("product_id"), F.concat(F.lit("line "), F.col("o_orderstatus")).alias("name"))
    # two thirds of the manufacturing orders come from elsewhere
    linked = k % 3 == 0
    made = o.select(
        k.alias("id"), F.concat(F.lit("MO"), k.cast("string")).alias("name"), F.when(linked, k).otherwise(-1 - k).alias("incoming_picking"),
        F.concat(F.when(linked, F.lit("SO")).otherwise(F.lit("other ")), (k + 1).cast("string")).alias("origin"),
        (F.col("o_custkey") % 100).alias("product_id"), F.lit(1).alias("product_qty"), F.lower("o_orderstatus").alias("state"),
    )
    return sale, lines, made


_TRACE_PICK = "made AS (SELECT 'SO' || CAST(o_orderkey AS VARCHAR) AS order_name, o_orderkey AS ref FROM orders WHERE o_orderkey % 3 = 0)"
_TRACE_ORIGIN = "made AS (SELECT 'SO' || CAST(m.o_orderkey + 1 AS VARCHAR) AS order_name, m.o_orderkey AS ref FROM orders m JOIN orders o ON o.o_orderkey = m.o_orderkey + 1 WHERE m.o_orderkey % 3 = 0)"


def _trace_sql(made: str) -> str:
    return f"""WITH {made}, so AS (SELECT 'SO' || CAST(o_orderkey AS VARCHAR) AS order_name, o_orderkey FROM orders)
    SELECT order_name, 'line' AS kind, unnest([o_orderkey * 2, o_orderkey * 2 + 1]) AS ref FROM so UNION ALL SELECT order_name, 'made', ref FROM made
    UNION ALL SELECT order_name, 'none', NULL FROM so WHERE order_name NOT IN (SELECT order_name FROM made)"""


def _trace(spark, sf, by: str) -> DataFrame:
    lines, made, without = orders.order_trace(*_sale_orders(spark, sf), by=by)
    return (
        lines.select("order_name", F.lit("line").alias("kind"), F.col("line_id").alias("ref"))
        .unionByName(made.select("order_name", F.lit("made").alias("kind"), F.col("mo_id").alias("ref")))
        .unionByName(without.select("order_name", F.lit("none").alias("kind"), F.lit(None).cast("bigint").alias("ref")))
    )


@query("order_trace", _trace_sql(_TRACE_PICK))
def order_trace(spark, sf):
    return _trace(spark, sf, "picking")


@query("order_trace_origin", _trace_sql(_TRACE_ORIGIN))
def order_trace_origin(spark, sf):
    return _trace(spark, sf, "origin")


@query(
    "picking_moves",
    """SELECT 'OUT' || CAST(o_orderkey AS VARCHAR) AS picking, CAST(i AS INTEGER) AS position, o_orderkey * 2 + i AS move_id, CAST(o_custkey % 100 AS BIGINT) AS product_id, 'WH' AS location_id,
    CAST(o_custkey % 7 AS BIGINT) AS product_uom_qty, CAST(o_custkey % 3 AS BIGINT) AS quantity_done FROM (SELECT *, unnest([0, 1]) AS i FROM orders WHERE o_orderstatus <> 'F')""",
)
def picking_moves(spark, sf):
    o = ad.table(spark, sf, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pickings = o.select(
        F.concat(F.lit("OUT"), k.cast("string")).alias("name"), F.when(F.col("o_orderstatus") == "F", F.lit("done")).otherwise(F.lit("assigned")).alias("state"), F.array(k * 2, k * 2 + 1).alias("move_lines")
    )
    moves = o.select(
        F.explode(F.array(k * 2, k * 2 + 1)).alias("move_id"), (c % 100).alias("product_id"), F.lit("WH").alias("location_id"), (c % 7).alias("product_uom_qty"), (c % 3).alias("quantity_done")
    )
    return orders.picking_moves(pickings, moves)


@query(
    "order_product_trace",
    """SELECT 'MO' || CAST(o_orderkey AS VARCHAR) AS mo_name, p_partkey AS product_tmpl_id, p_name AS product_name, p_type AS category FROM orders JOIN part ON p_partkey = o_custkey""",
)
def order_product_trace(spark, sf):
    o, p = ad.table(spark, sf, "orders"), ad.table(spark, sf, "part")
    productions = o.select(F.concat(F.lit("MO"), F.col("o_orderkey").cast("string")).alias("name"), F.col("o_custkey").alias("product_tmpl_id"))
    templates = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("categ_name"))
    return orders.order_product_trace(productions, templates)


@query(
    "first_line_variant",
    """SELECT 'SO' || CAST(o_orderkey AS VARCHAR) AS order_name, o_orderkey * 2 AS line_id, 'line ' || o_orderstatus AS line_name, o_custkey % 100 AS product_id
    FROM orders WHERE o_custkey % 100 < (SELECT count(*) FROM supplier) AND (o_custkey % 100) % 2 = 0""",
)
def first_line_variant(spark, sf):
    sale, lines, _ = _sale_orders(spark, sf)
    key = F.col("s_suppkey")
    variants = ad.table(spark, sf, "supplier").select(F.when(key % 2 == 0, key).otherwise(-1 - key).alias("id"))
    return orders.first_line_variant(sale, lines, variants)


@query(
    "delivery_note_trace",
    """SELECT o_orderkey AS invoice_line_id, o_orderkey AS note_id, 'DN' || CAST(o_orderkey AS VARCHAR) AS note_name, 'route ' || CAST(o_custkey % 5 AS VARCHAR) AS transport_line, o_orderstatus AS delivery_mode,
    CAST(o_orderdate AS DATE) AS schedule_date, CAST(CAST(o_orderdate AS DATE) + 2 AS DATE) AS delivery_date, o_orderkey + 7 AS invoice_id, 'IV' || CAST(o_orderkey AS VARCHAR) AS invoice_name,
    CAST(o_orderdate AS DATE) AS invoice_date, c_name AS partner_name, 'SO' || CAST(o_orderkey AS VARCHAR) AS so_number, o_orderkey + 9 AS delivery_id FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderkey % 4 <> 0""",
)
def delivery_note_trace(spark, sf):
    o = ad.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    notes = o.select(
        k.alias("id"), F.concat(F.lit("DN"), k.cast("string")).alias("name"), F.concat(F.lit("route "), (F.col("o_custkey") % 5).cast("string")).alias("transport_line"),
        F.col("o_orderstatus").alias("delivery_mode"), day.alias("schedule_date"), F.date_add(day, 2).alias("delivery_date"),
        F.when(k % 4 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k, k + 1)).alias("invoice_line_ids"),
    )
    names = ad.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("partner_name"))
    invoice_lines = o.join(names, "o_custkey").select(
        k.alias("invoice_line_id"), (k + 7).alias("invoice_id"), F.concat(F.lit("IV"), k.cast("string")).alias("invoice_name"), day.alias("invoice_date"), "partner_name",
        F.concat(F.lit("SO"), k.cast("string")).alias("so_number"), (k + 9).alias("delivery_id"),
    )
    return orders.delivery_note_trace(notes, invoice_lines)


@query(
    "sheet_orders",
    """SELECT ['no1','no2','no3','self_checkout'][l_suppkey % 4 + 1] AS store, 'C' || CAST(l_partkey AS VARCHAR) AS sku, CAST(l_quantity AS INTEGER) AS quantity,
    CASE WHEN l_partkey % 6 <> 0 THEN l_partkey END AS product_id FROM lineitem""",
)
def sheet_orders(spark, sf):
    li = ad.table(spark, sf, "lineitem")
    sheet = li.select(
        ad.pick(["no1", "no2", "no3", "self_checkout"], F.col("l_suppkey") % 4).alias("store"), F.concat(F.lit("C"), F.col("l_partkey").cast("string")).alias("sku"), F.col("l_quantity").cast("int").alias("quantity")
    )
    key = F.col("p_partkey")
    code = F.concat(F.when(key % 6 != 0, F.lit("C")).otherwise(F.lit("?")), key.cast("string"))
    products = ad.table(spark, sf, "part").select(code.alias("default_code"), key.alias("id"))
    found, rejected = orders.sheet_orders(sheet, products)
    return found.select("store", "sku", "quantity", "product_id").unionByName(rejected.withColumn("product_id", F.lit(None).cast("bigint")))


# ---- fabric products ----


def _fabric(spark, sf, first_load: bool) -> DataFrame:
    p = ad.table(spark, sf, "part")
    k = F.col("p_partkey")
    numbers_ = ["Width", "PriceOut", "Price", "PriceRate1", "PriceRate2", "Discount1", "Discount2", "HPrice", "HDiscount", "smBal", "smReserve", "smScrab"]
    raw = p.select(
        F.when(k % 25 == 0, F.lit("  ")).otherwise(F.concat(F.lit("ผ"), F.col("p_brand"), F.lit("-"), k.cast("string"), F.lit("\u0007 "))).alias("RefCode"),
        F.col("p_name").alias("RefValue"),
        F.when(k % 3 == 0, F.lit("None")).otherwise(F.concat(F.lit(" "), F.col("p_type"))).alias("RefDescription"),
        *[F.lit("M").alias(c) for c in ("UnitUOM", "WidthTxt", "WidthUOM", "composition", "Owner")],
        *[F.when(k % 5 != 0, F.col("p_retailprice")).cast(MONEY).alias(c) for c in numbers_],
        (k % 4 != 1).cast("int").alias("FlagDelete"),
    )
    raw_cols = list(catalog.FABRIC_COLUMNS)
    code = F.concat(F.col("p_brand"), F.lit("-"), k.cast("string"))
    target = p.select(
        F.when(k % 2 == 0, code).otherwise(F.concat(F.lit("?"), code)).alias("ref_code"),
        *[F.lit("old").alias(catalog.FABRIC_COLUMNS[c]) for c in raw_cols if c in ("RefValue", "RefDescription", "UnitUOM", "WidthTxt", "WidthUOM", "composition", "Owner")],
        *[F.lit(0).cast(MONEY).alias(catalog.FABRIC_COLUMNS[c]) for c in numbers_],
        F.lit(1).alias("flag_delete"),
        (k % 9 + 1).cast("int").alias("product_category_id"),
        F.when(k % 6 == 0, F.lit(0)).otherwise(F.lit(1)).alias("active"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )
    match = p.select(F.when(k % 3 == 0, code).otherwise(F.concat(F.lit("?"), code)).alias("ref_code"), F.col("p_type").alias("category_name"))
    categories = ad.table(spark, sf, "region").select(
        F.col("r_regionkey").alias("id"), ad.pick(["ECONOMY", "PROMO", "SMALL", "STANDARD", "LARGE"], F.col("r_regionkey")).alias("name")
    )
    out = catalog.fabric_product_load(raw, target, match, categories, ad.RUN_TS, first_load)
    return out.select("ref_code", "ref_value", "ref_description", "price", "flag_delete", "product_category_id", "active", "created_at", "updated_at")


def _fabric_sql(first_load: bool) -> str:
    named = "CASE WHEN p_partkey % 3 = 0 THEN CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'STANDARD' THEN 3 WHEN 'LARGE' THEN 4 END END"
    category = f"coalesce({named}, 8)" if first_load else "CASE WHEN known THEN p_partkey % 9 + 1 ELSE 8 END"
    active = "1" if first_load else "CASE WHEN known AND p_partkey % 6 = 0 THEN 0 ELSE 1 END"
    return f"""SELECT p_brand || '-' || CAST(p_partkey AS VARCHAR) AS ref_code, CASE WHEN listed THEN p_name ELSE 'old' END AS ref_value,
      CASE WHEN NOT listed THEN 'old' WHEN p_partkey % 3 <> 0 THEN p_type END AS ref_description,
      CAST(CASE WHEN listed AND p_partkey % 5 <> 0 THEN p_retailprice ELSE 0 END AS {q.M}) AS price,
      CAST(CASE WHEN listed AND p_partkey % 4 = 1 THEN 0 ELSE 1 END AS INTEGER) AS flag_delete,
      CAST(CASE WHEN listed THEN {category} ELSE p_partkey % 9 + 1 END AS INTEGER) AS product_category_id,
      CAST(CASE WHEN listed THEN CASE WHEN known AND p_partkey % 4 = 1 THEN 0 ELSE {active} END WHEN p_partkey % 6 = 0 THEN 0 ELSE 1 END AS INTEGER) AS active,
      CASE WHEN known THEN TIMESTAMP '2020-01-01 00:00:00' ELSE {q.RUN_TS} END AS created_at, CASE WHEN listed THEN {q.RUN_TS} ELSE TIMESTAMP '2020-01-01 00:00:00' END AS updated_at
    FROM (SELECT *, p_partkey % 25 <> 0 AS listed, p_partkey % 2 = 0 AS known FROM part) WHERE listed OR known
    UNION ALL SELECT '?' || p_brand || '-' || CAST(p_partkey AS VARCHAR), 'old', 'old', 0, 1, CAST(p_partkey % 9 + 1 AS INTEGER), 1, TIMESTAMP '2020-01-01 00:00:00', TIMESTAMP '2020-01-01 00:00:00'
    FROM part WHERE p_partkey % 2 = 1"""


@query("fabric_product_load", _fabric_sql(False))
def fabric_product_load(spark, sf):
    return _fabric(spark, sf, first_load=False)


@query("fabric_product_first_load", _fabric_sql(True))
def fabric_product_first_load(spark, sf):
    return _fabric(spark, sf, first_load=True)


# ---- calendar and pages ----


@query(
    "sequence_month_ranges",
    """SELECT c_custkey AS sequence_id, CAST(m AS DATE) AS date_from, CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS date_to
    FROM (SELECT c_custkey, unnest(generate_series(DATE '2025-01-01', DATE '2025-12-01', INTERVAL 1 MONTH)) AS m FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def sequence_month_ranges(spark, sf):
    c = ad.table(spark, sf, "customer")
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Sale Advance no")).otherwise(F.lit("Invoice no"))
    return calendar.sequence_month_ranges(c.select(F.col("c_custkey").alias("id"), name.alias("name")), dt.date(2025, 1, 1), dt.date(2025, 12, 31))


_SHOP = "https://shop.example/"


@query(
    "page_product_links",
    f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS position, '{_SHOP}' || hrefs[i] AS link
    FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM pages))""",
)
def page_product_links(spark, sf):
    # the navigation entries of every page dressed as product cards, with a commented-out card in front
    card = '<div class="col" x-data="ProductCard"><span>new</span><a data-id="7" class="link product-name" href="'
    html = F.regexp_replace("html", '<li><a href="', card)
    decoy = F.lit('<!-- <div x-data="ProductCard"><a class="product-name" href="/gone"></a> -->')
    return pages.page_product_links(ad.table(spark, sf, "pages").select("page_id", F.concat(decoy, html).alias("html")), _SHOP)


# every entry of a page's navigation becomes a card around its neighbour's: with a link, without one, or with a link in a card of its own inside
_NESTED = """li AS (SELECT page_id, i, hrefs[i] AS href FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i
    FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM pages))),
  kinds AS (SELECT *, CASE WHEN starts_with(href, '/a') THEN 0 WHEN contains(href, 'e') THEN 2 ELSE 1 END AS kind FROM li),
  placed AS (SELECT *, i - 1 + coalesce(sum(CASE WHEN kind = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM kinds)"""


@query(
    "page_product_links_nested",
    f"""WITH {_NESTED} SELECT page_id, CAST(place + inner_card AS INTEGER) AS position, '{_SHOP}' || href AS link
    FROM placed, (SELECT unnest([0, 1]) AS inner_card) WHERE kind > 0 AND inner_card < kind""",
)
def page_product_links_nested(spark, sf):
    """Cards without a link before an anchor outside of any card, cards inside cards, void, self-closing and unclosed tags, end tags of nothing."""
    bare = '<div x-data="ProductCard"><br><img src="/x.png"><hr/><p>no link<span></div></b><a class="product-name" href="/outside">'
    plain = '<div x-data="ProductCard"><p>unclosed<p title="a > b">more<a class="c product-name" href="$1"></a></section></div><a class="product-name" href="/outside">'
    nested = "<DIV x-data='ProductCard'><ul><li><div x-data='ProductCard'><i><a href='$1' class='product-name'>in</a></div><li></DIV><a class='product-name' href='/outside'>"
    html = F.regexp_replace("html", '<li><a href="(/a[^"]*)">', bare)
    html = F.regexp_replace(html, '<li><a href="([^"]*e[^"]*)">', nested)
    html = F.regexp_replace(html, '<li><a href="([^"]*)">', plain)
    return pages.page_product_links(ad.table(spark, sf, "pages").select("page_id", html.alias("html")), _SHOP)


@query(
    "page_image_cards",
    f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS position, CASE WHEN contains(hrefs[i], 'https') THEN hrefs[i] ELSE '{_SHOP}' || hrefs[i] END AS image_link, trim(names[i]) AS description
    FROM (SELECT page_id, hrefs, names, unnest(range(1, len(hrefs) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs,
      regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)<', 1) AS names FROM pages))""",
)
def page_image_cards(spark, sf):
    card = (
        "<div class='card col-md-3 border-0'><img src=\"$1\" class=\"card-img-top\"/><a class=\"card-title fw-bold\" href=\"#\"><p> $2 </p></a></div><!-- $1 -->"
    )
    html = F.regexp_replace("html", '<li><a href="([^"]*)">([^<]*)</a></li>', card)
    return pages.page_image_cards(ad.table(spark, sf, "pages").select("page_id", html.alias("html")), _SHOP)
