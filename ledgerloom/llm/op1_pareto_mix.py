"""Mixing sources to target weights by Pareto order sampling.

A source with target t and size S (both in words) gets floor(t / S) whole copies of each document. The rest,
R = t - floor(t / S) * S words, is a Pareto sample: the inclusion probability is p = min(1, c * size) with c such that
the expected words are R; documents are ranked by the random odds u / (1 - u) over the inclusion odds
p / (1 - p), and the first ones that fill R are taken. The size of the sample is fixed in words, not in documents:
the last place goes to the remaining document whose size comes nearest to the words still open, if it comes
nearer than leaving the place empty. The random number follows from the doc_id and the seed.

Defined results: null or blank text has size 0 and is never taken; a null source is a source of its own, after the
others; a null doc_id has one random number; repeated rows share theirs and are ranked as separate rows; a source of
size 0 has target 0; an empty table gives no rows. All columns of any names are passed on by `mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import body, read, whole_row
from ledgerloom.session import materialise

# Fixed values of the contract: weights repeat over the sources, a source is taken three times at most.
WEIGHTS = (5, 2, 1)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"

SEED = "pareto"
BINS = 1 << 16


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight of the sum of all sizes, none above most times its size.

    With a common factor f each target is min(most * size, f * weight). In the order of most * size / weight the sources that
    reach their limit come first, so f follows from the sums before each source. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    base = sizes.withColumn("weight", weight).withColumn("most", (F.lit(most) * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    factor = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(ahead), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ahead), F.lit(0.0))
    )
    found = base.withColumn("factor", factor).withColumn("full", F.col("factor") * F.col("weight") > F.col("most"))
    common = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), F.col("factor")))).over(everything)["factor"]
    target = F.when(F.col("full"), F.col("most")).otherwise(F.least("most", common * F.col("weight")))
    return found.select("source", "source_size", target.alias("target"))


def uniform(key: Column, seed: str = SEED) -> Column:
    """In (0, 1), from 52 bits of a hash."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def pareto_copies(sized: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """sized (row_id, doc_id, source, size; a written table) with source_size, target and copies.

    No group is sorted as a whole: words are summed by (source, bin of the rank value), and only the bin in which a
    source's sample ends is put in order.
    """
    t = targets.select(
        F.col("source").alias("__source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
    ).withColumn("open", F.when(F.col("source_size") > 0, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0))

    # c of each source: sizes above a limit are certain, the others share what is left in proportion to their size
    steps = sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    up = Window.partitionBy("source").orderBy("size")
    words_of = (F.col("n") * F.col("size")).cast("decimal(38,0)")
    squares = F.col("n").cast("decimal(18,0)") * (F.col("size") * F.col("size")).cast("decimal(19,0)")
    steps = steps.withColumn("above", F.coalesce(F.sum(words_of).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double"))
    steps = steps.withColumn("squares", F.sum(squares).over(up).cast("double"))
    steps = steps.join(t, F.col("source").eqNullSafe(F.col("__source")))
    rest = F.col("open") - F.col("above")
    limit = steps.where(rest * F.col("size") <= F.col("squares")).groupBy("__source").agg(F.max_by(rest / F.col("squares"), F.col("size")).alias("c"))
    t = t.join(limit.withColumnRenamed("__source", "__s"), F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s")
    # tables of one row per source are written: their size is known then, and rows need no shuffle to meet a small one
    t = materialise(t, "mix-targets")

    p = F.least(F.lit(1.0), F.coalesce(F.col("c"), F.lit(0.0)) * F.col("size"))
    u = uniform(F.col("doc_id"), seed)
    value = (u * (1 - p)) / (u * (1 - p) + (1 - u) * p)  # odds ratio q as q / (1 + q)
    rows = sized.join(t, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = rows.withColumn("value", F.when(F.col("size") > 0, value).otherwise(1.0))
    rows = rows.withColumn("bin", F.when(F.col("value") == 0, -1).otherwise(F.floor(F.col("value") * BINS)).cast("int"))

    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"), F.first("open").alias("open"))
    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(ahead), F.lit(0)))
    last = (
        bins.where((F.col("before") <= F.col("open")) & (F.col("before") + F.col("bin_size") > F.col("open")))
        .groupBy("source")
        .agg(F.min(F.struct("bin", "before")).alias("last"))
        .select(F.col("source").alias("__source"), F.col("last.bin").alias("last_bin"), F.col("last.before").alias("before"))
    )
    last = materialise(last, "mix-last")
    placed = rows.join(last, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    inside = placed.where("bin = last_bin")
    order = Window.partitionBy("source").orderBy("value", "doc_id", "size", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("after", F.col("before") + F.sum("size").over(order)).withColumn("taken_once", F.col("after") <= F.col("open"))
    outside = placed.where("last_bin is null or bin != last_bin").withColumns(
        {"after": F.lit(None).cast("long"), "taken_once": F.coalesce(F.col("last_bin").isNull() | (F.col("bin") < F.col("last_bin")), F.lit(False))}
    )
    # where no bin ends the sample, it takes all; nothing is open then unless every document is taken
    chosen = outside.unionByName(inside).withColumn("taken_once", F.col("taken_once") & (F.col("open") > 0) & (F.col("size") > 0))
    chosen = materialise(chosen, "mix-chosen")
    gaps = (
        chosen.groupBy("source")
        .agg(F.first("open").alias("o"), F.sum(F.when(F.col("taken_once"), F.col("size")).otherwise(0)).alias("got"))
        .select(F.col("source").alias("__source"), (F.col("o") - F.col("got")).alias("gap"))
    )
    gaps = materialise(gaps, "mix-gaps")
    near = chosen.join(gaps, F.col("source").eqNullSafe(F.col("__source"))).where("not taken_once and size > 0 and size < 2 * gap")
    closing = near.groupBy("source").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")), "value", "doc_id", "row_id")).alias("m")).select(F.col("m.row_id").alias("__row"))
    closing = materialise(closing, "mix-closing")
    return (
        chosen.join(closing, F.col("row_id") == F.col("__row"), "left")
        .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.when(F.col("taken_once") | F.col("__row").isNotNull(), 1).otherwise(0)).otherwise(0).cast("long"))
        .select("row_id", "doc_id", "source", "size", "source_size", "target", "copies")
    )


def mix(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per row of rows (row_id, doc_id, text, source): row_id, doc_id, source, size, source_size, target, copies."""
    sized = materialise(rows.select("row_id", "doc_id", "source", words(body()).alias("size")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return pareto_copies(sized, source_targets(totals, weights, most), seed)


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs."""
    rows = materialise(docs.select(whole_row(docs), F.monotonically_increasing_id().alias("row_id")), "mix-rows")
    copies = mix(rows.select("row_id", "doc.doc_id", "doc.text", "doc.source"), weights, most, seed)
    copies = materialise(copies.where("copies > 0").select("row_id", "copies"), "mix-copies")
    out = rows.join(copies.hint("merge"), "row_id")  # no broadcast: the table grows with the rows
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source").withColumn("row_id", F.monotonically_increasing_id())
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         (3 * source_size)::DOUBLE AS most FROM totals
), f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS factor
  FROM w
), t AS (
  SELECT source, source_size, CASE WHEN factor * weight > most THEN most
         ELSE least(most, (SELECT min_by(factor, most / weight) FROM f WHERE NOT factor * weight > most) * weight) END AS target FROM f
), o AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN target - floor(target / source_size)::BIGINT * source_size ELSE 0 END AS open FROM t
), steps AS (
  SELECT source, size, count(*) AS n FROM sized WHERE size > 0 GROUP BY ALL
), limits AS (
  SELECT source, size, coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS above,
         (sum(n * size * size) OVER (PARTITION BY source ORDER BY size))::DOUBLE AS squares FROM steps
), cs AS (
  SELECT l.source, max_by((o.open - above) / squares, size) AS c FROM limits l JOIN o ON l.source IS NOT DISTINCT FROM o.source
  WHERE (o.open - above) * size <= squares GROUP BY l.source
), ranked AS (
  SELECT s.doc_id, s.source, s.size, o.source_size, o.target, o.whole, o.open, least(1.0::DOUBLE, coalesce(cs.c, 0) * s.size) AS p,
         (('0x' || substr(md5('pareto:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN o ON s.source IS NOT DISTINCT FROM o.source LEFT JOIN cs ON s.source IS NOT DISTINCT FROM cs.source
), valued AS (
  SELECT *, CASE WHEN size > 0 THEN (u * (1 - p)) / (u * (1 - p) + (1 - u) * p) ELSE 1.0 END AS value FROM ranked
), run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY value, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after FROM valued
), once AS (
  SELECT *, after <= open AND open > 0 AND size > 0 AS taken_once FROM run
), gap AS (
  SELECT *, open - coalesce(sum(size) FILTER (taken_once) OVER (PARTITION BY source), 0) AS gap FROM once
), closing AS (
  SELECT *, NOT taken_once AND size > 0 AND size < 2 * gap AND
         row_number() OVER (PARTITION BY source, NOT taken_once AND size > 0 AND size < 2 * gap ORDER BY abs(gap - size), value, doc_id) = 1 AS closes FROM gap
)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN (whole + CASE WHEN taken_once OR closes THEN 1 ELSE 0 END) * size ELSE 0 END::BIGINT AS taken, source,
       CASE WHEN size > 0 THEN whole + CASE WHEN taken_once OR closes THEN 1 ELSE 0 END ELSE 0 END::BIGINT AS copies
FROM closing
"""
