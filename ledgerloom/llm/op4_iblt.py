"""Document fingerprints by invertible Bloom lookup sketches; DataFrame functions only.

A text is the set of the digests of its paragraphs: its lines, long lines cut after sentence ends, so that an edit touches few of them. The
sketch has TABLES tables of WIDTH cells; a digest is added to one cell of each table, and a cell holds the number of its digests, their exclusive or, and the
exclusive or of their check values. Two sketches are subtracted cell by cell, common digests vanish, and peeling recovers the others: a cell with one digest
names it, it is taken out of its other cells, and so on. Where that fails, the difference is larger than the sketch; both sides are then
sketched anew with more cells (4 to 64 sketches by the number of digests, each for its share of them), again only for the shares that fail, DEPTH times.
Shares that fail even then (some millions of differing paragraphs) are compared directly.

Likeness is the Jaccard similarity of the two sets, from their sizes and the number of recovered digests; two empty sets are alike.

Defined results: null text is empty; rows go by doc_id, null last, then by a hash of the text; repeated paragraphs of a text count
once; a single row is its own next document; equal texts have equal fingerprints; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import body, ranges, read
from ledgerloom.session import materialise

PARAGRAPH = r"[^\n]{119,}?[.!?]+|[^\n]+"
TABLES = 3
WIDTH = 8  # a power of two: bits of the digest choose the cell
LOAD = 24
DEPTH = 3
ROUNDS = 12
_BITS = 6
_SHIFTS = tuple(range(40, 40 + 6 * TABLES, 6))  # of the bits that choose the cell in each table
_CELL = "struct<n:int,x:bigint,c:bigint,m:bigint,t:bigint>"
_DIGEST = "array<struct<x:bigint,n:int>>"
_SHARES = "array<struct<a:array<bigint>,b:array<bigint>>>"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def paragraphs(text: Column) -> Column:
    """Digests of the distinct paragraphs."""
    pieces = F.filter(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), 0), lambda p: F.btrim(p)), lambda p: p != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def check(x: Column) -> Column:
    return F.xxhash64(F.lit("check"), x)


def sketch(digests: Column) -> Column:
    """The cells of a set of digests. A cell carries the bits (t, under the mask m) that a digest in it has."""

    def cell(mask: int) -> Callable[[Column], Column]:
        def filled(bits: Column) -> Column:
            nothing = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("c"), F.lit(mask).alias("m"), bits.alias("t"))
            return F.aggregate(
                F.filter(digests, lambda x: x.bitwiseAND(F.lit(mask)) == bits),
                nothing,
                lambda acc, x: F.struct(
                    (acc["n"] + 1).alias("n"), acc["x"].bitwiseXOR(x).alias("x"), acc["c"].bitwiseXOR(check(x)).alias("c"), acc["m"].alias("m"), acc["t"].alias("t")
                ),
            )

        return filled

    return F.concat(*[F.transform(F.lit([b << s for b in range(WIDTH)]).cast("array<bigint>"), cell((WIDTH - 1) << s)) for s in _SHIFTS])


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(
        left,
        right,
        lambda a, b: F.struct(
            (a["n"] - b["n"]).alias("n"), a["x"].bitwiseXOR(b["x"]).alias("x"), a["c"].bitwiseXOR(b["c"]).alias("c"), a["m"].alias("m"), a["t"].alias("t")
        ),
    )


def peel(cells: Column) -> Column:
    """struct(cells, found): found holds the digests with +1 (left only) or -1 (right only); the difference is whole if the cells are all empty."""

    def pure(now: Column) -> Column:
        single = F.filter(now, lambda c: (F.abs(c["n"]) == 1) & (check(c["x"]) == c["c"]))
        return F.array_distinct(F.transform(single, lambda c: F.struct(c["x"].alias("x"), c["n"].alias("n"))))

    def without(now: Column, gone: Column) -> Column:
        def rest(cell: Column) -> Column:
            return F.aggregate(
                F.filter(gone, lambda g: g["x"].bitwiseAND(cell["m"]) == cell["t"]),
                cell,
                lambda acc, g: F.struct(
                    (acc["n"] - g["n"]).alias("n"), acc["x"].bitwiseXOR(g["x"]).alias("x"), acc["c"].bitwiseXOR(check(g["x"])).alias("c"), acc["m"].alias("m"), acc["t"].alias("t")
                ),
            )

        return F.transform(now, rest)

    def step(state: Column, _: Column) -> Column:
        done = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("going"))
        return F.when(~state["going"], state).otherwise(
            let(
                pure(state["cells"]),
                lambda gone: F.when(F.size(gone) == 0, done).otherwise(
                    F.struct(without(state["cells"], gone).alias("cells"), F.concat(state["found"], gone).alias("found"), F.lit(True).alias("going"))
                ),
            )
        )

    start = F.struct(cells.cast(f"array<{_CELL}>").alias("cells"), F.array().cast(_DIGEST).alias("found"), F.lit(True).alias("going"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def whole(cells: Column) -> Column:
    return F.forall(cells, lambda c: (c["n"] == 0) & (c["x"] == 0) & (c["c"] == 0))


def shares(left: Column, right: Column, level: int) -> Column:
    """array of struct(a, b): both sets dealt out by bits of the digest to so many shares that about LOAD digests come to one (4 to 64)."""
    wanted = F.least(F.greatest(F.ceil(F.log2((F.size(left) + F.size(right)) / LOAD)), F.lit(2)), F.lit(_BITS))
    last = F.pow(F.lit(2.0), wanted).cast("int") - 1

    def part(side: Column, share: Column) -> Column:
        return F.filter(side, lambda x: F.shiftrightunsigned(x, _BITS * level).bitwiseAND(last.cast("long")) == share)

    return F.transform(F.sequence(F.lit(0), last), lambda share: F.struct(part(left, share).alias("a"), part(right, share).alias("b")))


def with_difference(df: DataFrame, left: Column, right: Column, left_cells: Column, right_cells: Column, name: str) -> DataFrame:
    """df with the column `name`: array of (digest, +1 or -1), what only one of two sets of digests holds.

    Each level is a column of its own: the sketches of the shares that the level before could not peel.
    """
    none = F.array().cast(_DIGEST)
    df = df.withColumn("__peeled", peel(subtract(left_cells, right_cells)))
    done = whole(F.col("__peeled.cells"))
    df = df.withColumn(name, F.when(done, F.col("__peeled.found").cast(_DIGEST)).otherwise(none))
    df = df.withColumn("__open", F.when(done, F.array().cast(_SHARES)).otherwise(F.array(F.struct(left.alias("a"), right.alias("b"))).cast(_SHARES)))
    for level in range(DEPTH):
        df = df.withColumn("__tried", _retried(level))
        df = df.withColumn(name, F.concat(name, F.flatten(F.transform(F.filter("__tried", lambda t: t["whole"]), lambda t: t["found"])).cast(_DIGEST)))
        df = df.withColumn("__open", F.transform(F.filter("__tried", lambda t: ~t["whole"]), lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"))).cast(_SHARES))
    df = df.withColumn(name, F.concat(name, F.flatten(F.transform("__open", lambda s: F.concat(_only(s["a"], s["b"], 1), _only(s["b"], s["a"], -1)))).cast(_DIGEST)))
    return df.drop("__peeled", "__tried", "__open")


def _only(a: Column, b: Column, sign: int) -> Column:
    return F.transform(F.array_except(a, b), lambda x: F.struct(x.alias("x"), F.lit(sign).alias("n")))


def _retried(level: int) -> Column:
    """The open shares dealt out further, each with its peeled difference."""
    dealt = F.flatten(F.transform("__open", lambda s: shares(s["a"], s["b"], level)))

    def tried(s: Column) -> Column:
        return let(
            peel(subtract(sketch(s["a"]), sketch(s["b"]))),
            lambda p: F.struct(s["a"].alias("a"), s["b"].alias("b"), whole(p["cells"]).alias("whole"), p["found"].alias("found")),
        )

    return F.transform(dealt, tried)


def likeness(left: Column, right: Column, apart: Column) -> Column:
    both = F.size(left) + F.size(right)
    return F.when(both == 0, 1.0).otherwise((both - F.size(apart)) / (both + F.size(apart)))


def as_text(cells: Column) -> Column:
    hexed = F.transform(cells, lambda c: F.concat(F.lpad(F.hex(c["n"].cast("long")), 8, "0"), F.lpad(F.hex(c["x"]), 16, "0"), F.substring(F.lpad(F.hex(c["c"]), 16, "0"), 9, 8)))
    return F.base64(F.unhex(F.array_join(hexed, "")))


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with digests, cells and `next`: struct(text, digests, cells) of the next document.

    doc_id ranges of equal size are ordered apart; each range gets one row more, the first of the range behind it.
    """
    spark = docs.sparkSession
    bucket, _ = ranges(docs, "doc_id")
    rows = docs.select("doc_id", body().alias("text")).withColumn("bucket", bucket).withColumn("tie", F.xxhash64("text"))

    # the first row of each range: at most one for each bound and two more
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "tie")).alias("first")).collect()
    firsts = sorted((r["bucket"], r["first"]["doc_id"], r["first"]["tie"]) for r in firsts)
    behind = [(bucket, *firsts[(i + 1) % len(firsts)]) for i, (bucket, _, _) in enumerate(firsts)]
    heads = spark.createDataFrame(behind, "before int, b int, id long, t long")
    heads = rows.join(F.broadcast(heads), (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("t")))
    heads = heads.groupBy("before").agg(F.first("text").alias("text"))
    heads = heads.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("before").alias("bucket"), F.lit(0).cast("long").alias("tie"), F.lit(True).alias("head"))
    every = rows.withColumn("head", F.lit(False)).unionByName(materialise(heads, "sketch-heads"))
    every = every.withColumn("digests", paragraphs(F.col("text"))).withColumn("cells", sketch(F.col("digests")))
    order = Window.partitionBy("bucket").orderBy("head", F.col("doc_id").asc_nulls_last(), "tie")
    return every.withColumn("next", F.lead(F.struct("text", "digests", "cells")).over(order)).where("not head").drop("head", "bucket", "tie")


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprints of each text and of its edited text, with their likeness and what the edit took and brought."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    out = with_next(docs).withColumn("n_chars", n.cast("long"))
    out = out.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)))
    out = out.withColumn("edited_digests", paragraphs(F.col("edited"))).withColumn("edited_cells", sketch(F.col("edited_digests")))
    out = with_difference(out, F.col("digests"), F.col("edited_digests"), F.col("cells"), F.col("edited_cells"), "apart")
    out = with_difference(out, F.col("digests"), F.col("next.digests"), F.col("cells"), F.col("next.cells"), "apart_next")
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("cells")).alias("fingerprint"),
        as_text(F.col("edited_cells")).alias("edited_fingerprint"),
        likeness(F.col("digests"), F.col("edited_digests"), F.col("apart")).alias("near_edited"),
        likeness(F.col("digests"), F.col("next.digests"), F.col("apart_next")).alias("near_next"),
        F.size(F.filter("apart", lambda d: d["n"] == 1)).alias("n_taken"),
        F.size(F.filter("apart", lambda d: d["n"] == -1)).alias("n_brought"),
    )


def op4_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))
