"""Order-dependent operators that stay parallel inside one group.

A plain window over a group key puts the whole group into one task. Here rows first get a block number
that never decreases along the order; a window runs per (key, block), and only one summary row per block
goes through the window over the key. A group holding a third of all rows is thus spread over its blocks.

Blocks come from a position column (`position_blocks`, for line numbers or byte offsets) or, for any other
order, from its quantiles (`quantile_blocks`): the rows are counted, a bounded sample of them is sorted, and tuples of the order columns'
own types cut it into one run for each shuffle partition. A row finds its block by comparing its tuple with them. The count and the sample
run while the plan is built; nothing is materialised.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom import session

BLOCK = "__block"
PART_CHARS = 1 << 20


def position_blocks(df: DataFrame, position: str, size: int = 1 << 20) -> DataFrame:
    """Block = position div size; position must not decrease along the order (line number, byte offset)."""
    return df.withColumn(BLOCK, F.floor(F.col(position) / F.lit(size)).cast("long"))


_DRAWN = 64  # rows in the sample for each block wanted


def _leaves(schema: T.StructType, order: Sequence[str]) -> list[tuple[Column, T.DataType]]:
    """The order columns as simple values: the fields of a structure follow one another, behind a flag that is lower where the structure is null."""

    def parts(c: Column, kind: T.DataType, nullable: bool) -> list[tuple[Column, T.DataType]]:
        if not isinstance(kind, T.StructType):
            return [(c, kind)]
        flag = [(c.isNotNull(), T.BooleanType())] if nullable else []
        return flag + [p for f in kind.fields for p in parts(c.getField(f.name), f.dataType, f.nullable)]

    return [p for name in order for p in parts(F.col(name), schema[name].dataType, schema[name].nullable)]


def _portable(c: Column, kind: T.DataType) -> Column:
    """c as a value that comes back from the driver as it was, whatever the time zones: times as text or microseconds."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    return c.cast("string") if isinstance(kind, (T.DateType, T.TimestampNTZType)) else c


def _literal(value, kind: T.DataType) -> Column:
    """The column for a value that _portable has brought here."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value).cast("bigint"))
    return F.lit(value).cast(kind)


def _same(a, b) -> bool:
    """Equal in Spark's order, where NaN equals itself."""
    return a == b or (a != a and b != b)


def _shortest(below: tuple, cut: tuple) -> tuple:
    """The shortest tuple above `below` and not above `cut`: nulls (the lowest values) follow the first difference, and a text ends there."""
    out = []
    for low, value in zip(below, cut, strict=True):
        differs = not _same(low, value)
        if differs and isinstance(low, str) and isinstance(value, str):
            value = value[: len(os.path.commonprefix([low, value])) + 1]
        out.append(value)
        if differs:
            break
    return (*out, *[None] * (len(cut) - len(out)))


def find_cuts(df: DataFrame, order: Sequence[str], blocks: int) -> list[tuple]:
    """Tuples of the order columns (structures by their fields) that cut df into about `blocks` equal runs, in order.

    Rows are counted, and a sample of about _DRAWN rows for each block is sorted by Spark's own order of the columns. Between the last
    tuple of one run and the first of the next stands the shortest that parts them, so a cut is no longer than it has to be.
    """
    leaves = _leaves(df.schema, order)
    names = [f"o{i}" for i in range(len(leaves))]
    tuples = df.select(*[c.alias(n) for n, (c, _) in zip(names, leaves, strict=True)])
    rows = tuples.count()
    drawn, run = (tuples, -(-rows // blocks) or 1) if rows <= _DRAWN * blocks else (tuples.sample(_DRAWN * blocks / rows, 0), _DRAWN)
    # sorted in one task, so the ids are places; the first and the last tuple of each run come back
    placed = drawn.repartition(1).sortWithinPartitions(*names).withColumn("at", F.monotonically_increasing_id())
    ends = placed.where((F.col("at") % run == 0) | (F.col("at") % run == run - 1))
    found = {r["at"]: tuple(r)[1:] for r in ends.select("at", *[_portable(F.col(n), k) for n, (_, k) in zip(names, leaves, strict=True)]).collect()}
    cuts: list[tuple] = []
    for at in sorted(found):
        if at and at % run == 0:
            cut = _shortest(found[at - 1], found[at])
            if not cuts or not all(map(_same, cuts[-1], cut)):
                cuts.append(cut)
    return cuts


_PIVOTS = 31  # cuts that a row is compared with in generated code


def _reached(cut: Sequence, own: Sequence[Column], kinds: Sequence[T.DataType]) -> Column:
    """Whether the row's tuple is at or above the cut, whose nulls are the lowest values."""
    out = F.lit(True)
    for value, c, kind in reversed(list(zip(cut, own, kinds, strict=True))):
        if value is None:
            out = c.isNotNull() | out
        else:
            v = _literal(value, kind)
            out = F.coalesce((c > v) | ((c == v) & out), F.lit(False))
    return out


def _block(cuts: Sequence[tuple], own: Sequence[Column], kinds: Sequence[T.DataType]) -> Column:
    """Number of cuts at or below the row's tuple: a tree of comparisons with some cuts, then halving of those between two of them.

    Behind the last column in which any cut has a value, cuts hold the lowest ones only: the columns before it decide.
    """
    if not cuts:
        return F.lit(0).cast("bigint")
    used = max([i + 1 for cut in cuts for i, v in enumerate(cut) if v is not None], default=1)
    own, kinds, cuts = own[:used], kinds[:used], [cut[:used] for cut in cuts]
    apart = -(-len(cuts) // _PIVOTS)
    pivots = range(apart - 1, len(cuts), apart)

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low * apart)
        middle = (low + high) // 2
        return F.when(_reached(cuts[pivots[middle]], own, kinds), tree(middle + 1, high)).otherwise(tree(low, middle))

    passed = tree(0, len(pivots))
    if apart == 1:
        return passed.cast("bigint")

    def row(columns: Sequence[Column]) -> Column:
        return F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)])

    table = F.array(*[row([_literal(v, k) for v, k in zip(cut, kinds, strict=True)]) for cut in cuts])
    steps = [1 << i for i in reversed(range((apart - 1).bit_length()))]

    def halve(now: Column, step: Column) -> Column:
        return now + F.when(F.get(table, now + step - 1) <= row(own), step).otherwise(0)

    return F.aggregate(F.array(*[F.lit(x) for x in steps]), passed, halve).cast("bigint")


@dataclass(frozen=True)
class Bounds:
    """Cuts along an order, to number the blocks of any frame that has its columns."""

    order: tuple[str, ...]
    cuts: tuple[tuple, ...]
    schema: T.StructType

    def assign(self, df: DataFrame) -> DataFrame:
        leaves = _leaves(self.schema, self.order)
        return df.withColumn(BLOCK, _block(self.cuts, [c.cast(k) for c, k in leaves], [k for _, k in leaves]))


def quantile_bounds(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> Bounds:
    """Bounds cutting df into about equal runs of the order. Taken from a frame distributed like the one to be
    cut (say, before its joins) they give even blocks; any bounds give right results."""
    n = blocks or max(session.shuffle_width(df.sparkSession), 8)
    return Bounds(tuple(order), tuple(find_cuts(df, order, n)), T.StructType([df.schema[name] for name in order]))


def quantile_blocks(
    df: DataFrame, order: Sequence[str], blocks: int | None = None, bounds_from: DataFrame | Bounds | None = None
) -> DataFrame:
    """Blocks of about equal row count along the order; bounds_from: a cheaper frame to take the bounds from, or bounds of the same order."""
    if isinstance(bounds_from, Bounds):
        if bounds_from.order != tuple(order):
            raise ValueError(f"bounds along {bounds_from.order}, not {tuple(order)}")
        return bounds_from.assign(df)
    return quantile_bounds(df if bounds_from is None else bounds_from, order, blocks).assign(df)


def _earlier_blocks(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def _inside_block(keys: Sequence[str], order: Sequence[str]):
    window = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


_STAND_INS = {T.StringType: "", T.DateType: "1970-01-01", T.TimestampType: "1970-01-01", T.TimestampNTZType: "1970-01-01", T.BooleanType: "false"}


def _keyed(df: DataFrame, keys: Sequence[str], like: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """df with null-free stand-ins for its keys (for those nullable in `like`, where given).

    Null keys form a group of their own. Joining on <=> would shuffle by other expressions than the window
    behind it; with plain columns both use one shuffle by (keys, block).
    """
    added, names = [], []
    for k in keys:
        field = (df if like is None else like).schema[k]
        if not field.nullable:
            names.append(k)
            continue
        stand_in = F.lit(_STAND_INS.get(type(field.dataType), "0")).cast(field.dataType)
        added += [F.coalesce(F.col(k), stand_in).alias(f"__k_{k}"), F.col(k).isNull().alias(f"__n_{k}")]
        names += [f"__k_{k}", f"__n_{k}"]
    return df.select("*", *added), names


def running_total(
    blocked: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Column],
    dtype: str = "decimal(28,2)",
    per_key: DataFrame | None = None,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add one inclusive running sum per entry of `values`; nulls count as 0.

    totals: {entry: column} also adds the sum over the whole key, taken from the block summaries.

    per_key: one row per key with further columns. They ride along with the block summaries, so attaching
    them does not send a whole key through one join task.

    Only summaries that have something to say (sums of earlier blocks, totals, columns of per_key) meet the rows: where most keys
    lie in one block they are few, and Spark broadcasts them when they measure small.
    """
    zero = F.lit(0).cast(dtype)
    added = [F.coalesce(v.cast(dtype), zero).alias(f"__v_{n}") for n, v in values.items()]
    with_values, group = _keyed(blocked.select("*", *added), keys)
    per_block = with_values.groupBy(*group, BLOCK).agg(*[F.sum(f"__v_{n}").cast(dtype).alias(f"__t_{n}") for n in values])
    before = per_block.select(
        *group,
        BLOCK,
        *[F.coalesce(F.sum(f"__t_{n}").over(_earlier_blocks(group)).cast(dtype), zero).alias(f"__b_{n}") for n in values],
        *[F.sum(f"__t_{n}").over(Window.partitionBy(*group)).cast(dtype).alias(out) for n, out in (totals or {}).items()],
    )
    extra = [c for c in (per_key.columns if per_key is not None else []) if c not in keys]
    telling = F.lit(bool(totals))
    for n in values:
        telling = telling | (F.col(f"__b_{n}") != zero)
    if per_key is not None:
        known, _ = _keyed(per_key.dropna(subset=list(keys)), keys, like=blocked)
        before = before.join(known.select(*group, *extra), group, "left")
        for c in extra:
            telling = telling | F.col(c).isNotNull()
    joined = with_values.join(before.where(telling), [*group, BLOCK], "left")
    window = _inside_block(group, order)
    out = joined
    for n in values:
        out = out.withColumn(n, (F.coalesce(f"__b_{n}", zero) + F.sum(f"__v_{n}").over(window)).cast(dtype))
    kept = [c for c in blocked.columns if c not in values]
    return out.select(*kept, *values, *(totals or {}).values(), *extra)


def row_numbers(blocked: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """1-based counter per key along the order."""
    return running_total(blocked, keys, order, {out: F.lit(1)}, dtype="bigint")


def last_known(
    blocked: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Column],
    before: dict[str, Column] | None = None,
    first: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the latest non-null value up to the row (values), above the row (before), or the first one (first)."""
    before, first = before or {}, first or {}
    wanted = {**values, **before, **first}
    position = F.struct(*order)
    with_values, group = _keyed(blocked.select("*", *[v.alias(f"__v_{n}") for n, v in wanted.items()]), keys)

    def summary(n: str) -> Column:
        place = F.when(F.col(f"__v_{n}").isNotNull(), position)
        return (F.min_by if n in first else F.max_by)(f"__v_{n}", place).alias(f"__t_{n}")

    def carried(n: str) -> Column:
        pick = F.first if n in first else F.last
        return pick(f"__t_{n}", ignorenulls=True).over(_earlier_blocks(group)).alias(f"__b_{n}")

    per_block = with_values.groupBy(*group, BLOCK).agg(*[summary(n) for n in wanted])
    joined = with_values.join(per_block.select(*group, BLOCK, *[carried(n) for n in wanted]), [*group, BLOCK])
    window = _inside_block(group, order)
    above = Window.partitionBy(*group, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    def found(n: str) -> Column:
        value, carry = F.col(f"__v_{n}"), F.col(f"__b_{n}")
        if n in first:
            return F.coalesce(carry, F.first(value, ignorenulls=True).over(window)).alias(n)
        return F.coalesce(F.last(value, ignorenulls=True).over(above if n in before else window), carry).alias(n)

    kept = [c for c in blocked.columns if c not in wanted]
    return joined.select(*kept, *[found(n) for n in wanted])


def forward_fill(blocked: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Empty cells take the nearest value above them."""
    return last_known(blocked, keys, order, {c: F.col(c) for c in cols}).select(*blocked.columns)


def skip_leading_rows(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Drop the first n rows of every key. Only n rows per key and task are shuffled to find the cut."""
    if n <= 0:
        return df
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    cut = (
        df.select(*keys, *order)
        .withColumn("__rank", rank)
        .where(F.col("__rank") <= n)
        .groupBy(*[F.col(k).alias(f"__r_{k}") for k in keys])
        .agg(F.max(F.struct(*order)).alias("__cut"))
    )
    match = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        match = same if match is None else match & same
    return df.join(cut, match, "inner").where(F.struct(*order) > F.col("__cut")).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every key along the order; one row per key and task reaches the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def ordered_text(
    blocked: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    separator: str,
    out: str,
    part_chars: int = PART_CHARS,
    trim_ends: tuple[str, str] | None = None,
) -> DataFrame:
    """Join the texts of a key along the order into parts of about part_chars characters.

    Nearly every key has the single part 0. A key with more text goes on in later parts (their numbers rise,
    joining them with the separator gives the whole text), so no task ever holds more than one part of a key.
    trim_ends = (pattern, pattern): what to cut from the start of the first and the end of the last text.
    """
    gap = len(separator) or 1
    texts = blocked.where(F.col(text).isNotNull()).withColumn("__len", F.length(text).cast("bigint") + gap)
    ends = running_total(texts, keys, order, {"__end": F.col("__len")}, dtype="bigint", totals={"__end": "__whole"})
    begin = F.col("__end") - F.col("__len")
    piece = F.col(text)
    if trim_ends:
        head, tail = trim_ends
        piece = F.when(begin == 0, F.regexp_replace(piece, head, "")).otherwise(piece)
        piece = F.when(F.col("__end") == F.col("__whole"), F.regexp_replace(piece, tail, "")).otherwise(piece)
    pieces = ends.select(
        *keys,
        F.floor(begin / part_chars).cast("int").alias("part_no"),
        F.struct(begin.alias("at"), piece.alias("piece")).alias("__piece"),
    )
    return pieces.groupBy(*keys, "part_no").agg(
        F.array_join(F.array_sort(F.collect_list("__piece")).getField("piece"), separator).alias(out)
    )


def first_part(parts: DataFrame, keys: Sequence[str], text: str, count: str, *others: Column) -> DataFrame:
    """One row per key of parts (of ordered_text): the text's first part and the number of its parts.

    Further parts stay where they are, rows of a table beside this one, so no key's whole text meets in a task or a cell.
    """
    first = F.max(F.when(F.col("part_no") == 0, F.col(text)))
    return parts.groupBy(*keys).agg(first.alias(text), F.count(text).cast("int").alias(count), *others)


def whole_text(parts: DataFrame, keys: Sequence[str], text: str, separator: str, *others: Column) -> DataFrame:
    """One row per key with the text of all its parts (of ordered_text) joined again, null where that is empty.

    The text is one cell, so Spark's bound of 2 GiB for a cell holds for it.
    """
    pieces = F.collect_list(F.struct("part_no", F.coalesce(F.col(text), F.lit("")).alias("piece")))
    joined = F.array_join(F.array_sort(pieces).getField("piece"), separator)
    return parts.groupBy(*keys).agg(F.nullif(joined, F.lit("")).alias(text), *others)
