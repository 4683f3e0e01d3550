"""Joins on codes: prefixes, contained text, code maps, look-ups. No nested-loop join in any plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.schemas import MONEY


def _known_lengths(df: DataFrame, col: str) -> Column:
    """Distinct text lengths of a code column as one scalar array (bounded by the code's width)."""
    lengths = df.where(F.length(col) > 0).agg(F.coalesce(F.collect_set(F.length(col)), F.array().cast("array<int>")))
    return lengths.scalar()


def _prefixes(codes: DataFrame, code: str, lengths: Column, out: str) -> DataFrame:
    """One row per prefix of each code whose length occurs on the other side."""
    fitting = F.array_intersect(F.sequence(F.lit(1), F.length(code)), lengths)
    return (
        codes.where(F.length(code) > 0)
        .select(code, F.explode(fitting).alias("__n"))
        .select(code, F.expr(f"substring(`{code}`, 1, __n)").alias(out))
    )


def longest_prefix(df: DataFrame, code: str, table: DataFrame, prefix: str, value: str, out: str) -> DataFrame:
    """Value of the longest table prefix that begins the code, else null. Matching runs on distinct codes."""
    table = table.where(F.length(prefix) > 0).select(F.col(prefix).alias("__prefix"), F.col(value).alias("__value"))
    codes = df.select(F.col(code).alias("__code")).distinct()
    best = (
        _prefixes(codes, "__code", _known_lengths(table, "__prefix"), "__prefix")
        .join(table, "__prefix")
        .groupBy("__code")
        .agg(F.max_by("__value", F.struct(F.length("__prefix"), F.col("__value"))).alias(out))
    )
    return df.join(best, F.col(code) == F.col("__code"), "left").drop("__code")


def starts_with_any(df: DataFrame, text: str, table: DataFrame, prefix: str) -> DataFrame:
    """Rows whose text begins with some table prefix."""
    table = table.where(F.length(prefix) > 0).select(F.col(prefix).alias("__prefix")).distinct()
    texts = df.select(F.col(text).alias("__text")).distinct()
    hits = (
        _prefixes(texts, "__text", _known_lengths(table, "__prefix"), "__prefix")
        .join(table, "__prefix", "left_semi")
        .select("__text")
        .distinct()
    )
    return df.join(hits, F.col(text) == F.col("__text"), "left_semi")


def sale_area_longest_prefix(
    docs: DataFrame, areas: DataFrame, code: str = "customer_code", prefix: str = "cuscod_startwith", area: str = "sale_area"
) -> DataFrame:
    return longest_prefix(docs, code, areas, prefix, area, "sale_area_code")


GRAM = 3


def _grams(text: Column, size: Column) -> Column:
    """The different substrings of a text with that length."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.array_distinct(F.transform(places, lambda at: F.substring(text, at, size)))


def contains_lookup(needles: DataFrame, needle: str, products: DataFrame, code: str, gram: int = GRAM) -> DataFrame:
    """Case-insensitive `code contains needle`, through an index of grams.

    A needle is looked up by the one of its grams that the fewest codes have, and what is found is tested once. Codes give a row for each place
    (a needle shorter than a gram is a gram itself, so for at most `gram` lengths), whatever the needles' lengths.
    """
    wanted = (
        needles.select(F.trim(F.col(needle)).alias(needle))
        .where(F.length(needle) > 0)
        .distinct()
        .withColumn("__low", F.lower(needle))
        .withColumn("__size", F.least(F.length("__low"), F.lit(gram)))
    )
    sizes = wanted.agg(F.coalesce(F.collect_set("__size"), F.array().cast("array<int>"))).scalar()
    codes = products.select(F.col(code).alias("__code")).where(F.length("__code") > 0).distinct().withColumn("__text", F.lower("__code"))
    index = (
        codes.select("__code", "__text", F.explode(F.array_intersect(F.sequence(F.lit(1), F.least(F.length("__text"), F.lit(gram))), sizes)).alias("__size"))
        .select("__code", "__text", F.explode(_grams(F.col("__text"), F.col("__size"))).alias("__gram"))
    )
    held = index.groupBy("__gram").agg(F.count(F.lit(1)).alias("__codes"))
    asked = wanted.select(needle, "__low", F.explode(_grams(F.col("__low"), F.col("__size"))).alias("__gram"))
    # a gram that no code has rules its needle out
    rarest = (
        asked.join(held, "__gram", "left")
        .groupBy(needle, "__low")
        .agg(F.min(F.struct(F.coalesce("__codes", F.lit(0)).alias("codes"), F.col("__gram").alias("gram"))).alias("__least"))
        .where("__least.codes > 0")
        .select(needle, "__low", F.col("__least.gram").alias("__gram"))
    )
    pairs = rarest.join(index, "__gram").where(F.contains("__text", "__low")).select(needle, "__code")
    return pairs.join(products, F.col("__code") == F.col(code)).drop("__code")


def code_map_with_missing(df: DataFrame, col: str, mapping: DataFrame, old: str, new: str, flag: str = "is_missing") -> DataFrame:
    """Replace a code through the map, keep it where absent; the flag tells that it did not change."""
    pairs = (
        mapping.where(F.col(old).isNotNull() & F.col(new).isNotNull())
        .groupBy(F.col(old).alias("__old"))
        .agg(F.max(new).alias("__new"))
    )
    joined = df.join(pairs, F.col(col) == F.col("__old"), "left")
    mapped = F.coalesce(F.col("__new"), F.col(col))
    flagged = joined.withColumn(flag, F.coalesce(mapped == F.col(col), F.lit(False)))
    return flagged.withColumn(col, mapped).drop("__old", "__new")


def _ceiling(wanted: Column, points: Sequence[float], low: int = 0) -> Column:
    """Place of the first of the sorted points at or above the value, by halving; the last one beyond them and for null."""
    if len(points) == 1:
        return F.lit(low)
    half = (len(points) - 1) // 2
    below = _ceiling(wanted, points[: half + 1], low)
    return F.when(wanted <= F.lit(f"{points[half]:.2f}").cast("decimal(5,2)"), below).otherwise(_ceiling(wanted, points[half + 1 :], low + half + 1))


def price_surface_lookup(
    requests: DataFrame,
    surface: DataFrame,
    heights: Sequence[float],
    widths: Sequence[float],
    width: str = "width",
    height: str = "height",
) -> DataFrame:
    """Price at the next grid point at or above (height, width), clamped to the last one.

    The grid axes are declared breakpoints of the price list, the surface is (height, width, price). It becomes one array of
    len(heights) * len(widths) prices (of several at a point, the highest; null where there is none), so requests are never shuffled.
    """
    rows, columns = sorted(heights), sorted(widths)

    def axis(points: Sequence[float]) -> Column:
        return F.array(*[F.lit(f"{p:.2f}").cast("decimal(5,2)") for p in points])

    def place(c: str, points: Sequence[float]) -> Column:
        return F.array_position(axis(points), F.col(c).cast("decimal(5,2)")) - 1

    grid = surface.select(place("height", rows).alias("__h"), place("width", columns).alias("__w"), F.col("price").cast(MONEY).alias("__price"))
    known = grid.where("__h >= 0 AND __w >= 0").groupBy((F.col("__h") * len(columns) + F.col("__w")).alias("__at")).agg(F.max("__price").alias("__price"))
    by_place = known.agg(F.map_from_entries(F.collect_list(F.struct(F.col("__at").cast("int"), "__price"))).alias("p"))
    prices = by_place.select(F.transform(F.sequence(F.lit(0), F.lit(len(rows) * len(columns) - 1)), lambda i: F.try_element_at("p", i))).scalar()
    found = requests.withColumn("__h", _ceiling(F.col(height).cast("decimal(15,4)"), rows)).withColumn("__w", _ceiling(F.col(width).cast("decimal(15,4)"), columns))
    return found.select(
        F.get(axis(rows), F.col("__h")).alias("grid_height"),
        F.get(axis(columns), F.col("__w")).alias("grid_width"),
        *requests.columns,
        F.get(prices, F.col("__h") * len(columns) + F.col("__w")).alias("price"),
    )


def priority_map_update(products: DataFrame, updates: DataFrame, key: str, name: str, priority: str, position: str) -> DataFrame:
    """Set the priority of listed products; of repeated names the last one counts."""
    last = updates.groupBy(F.trim(F.col(name)).alias("__name")).agg(
        F.max_by(F.trim(F.col(priority)).try_cast("int"), F.col(position)).alias("__priority")
    )
    joined = products.join(last, F.col(key).cast("string") == F.col("__name"), "left")
    return joined.withColumn("priority", F.coalesce("__priority", "priority")).drop("__name", "__priority")


def key_anti_fill(df: DataFrame, keys: DataFrame, key: str, fill: dict[str, Column]) -> DataFrame:
    """Append one filler row for every key that df lacks."""
    absent = keys.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")
    filler = absent.select(key, *[value.alias(name) for name, value in fill.items()])
    return df.unionByName(filler, allowMissingColumns=True)


def scope_mask(df: DataFrame, key: str, scope: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns keep their value for keys in scope and read 0 otherwise."""
    known = scope.select(F.col(scope.columns[0]).alias("__key")).distinct().withColumn("__in", F.lit(True))
    joined = df.join(known, F.col(key) == F.col("__key"), "left")
    for c in cols:
        joined = joined.withColumn(c, F.when(F.col("__in"), F.col(c)).otherwise(F.lit(0).cast(df.schema[c].dataType)))
    return joined.drop("__key", "__in")
