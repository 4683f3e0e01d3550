"""Personal data and the words that give it away, by information content; DataFrame functions only.

Base spans are emails, IP addresses, cards and phone numbers. Their values are the protected entities. Around each occurrence NEAR words on either
side are its context; equal contexts of an entity count once, so copies and near copies of a document prove nothing. A term that stands in
MIN_CONTEXTS different contexts of an entity or more is weighed: with p(t) the share of all documents that hold the term, p(t|e) the share of the
entity's contexts that do and p(e) the share of documents that hold the entity, its pointwise mutual information log(p(t|e) / p(t)) is compared with
the entity's information content -log p(e). The quotient, 1 at most, is how much of the entity the term discloses. From REMOVE on
the term is removed, from GENERALISE on it is generalised to its class, in every document that holds the entity. Documents without base spans stay as they are.

Positions count code points. The patterns below are linear forms of the contract's: possessive, and started only where a leftmost match can start.

Defined results: null text is empty, has no spans and stays null; a null doc_id and repeated rows are treated row by row; terms that
overlap a base span are left to it; overlapping spans are masked together under the first one's label; an empty table gives no rows; all columns
of any names are passed on by `sanitised`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import body, read, whole_row
from ledgerloom.session import materialise

# Fixed values of the contract: kinds in their order and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)

GENERALISED, REMOVED = "term_generalised", "term_removed"
NEAR = 6
NEAR_CHARS = 160
MIN_CONTEXTS = 2
GENERALISE = 0.6
REMOVE = 0.9
TERM = r"[\p{L}\p{M}\p{N}]++"
NOT_TERM = r"[^\p{L}\p{M}\p{N}]+"
FEW_TERMS = 10_000
_CHUNK = 64

_FOUND = "array<struct<start:int,end:int,value:string>>"
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def located(text: Column, pattern: str) -> Column:
    """array of (start, end, value) of the pattern's matches: the parts between them give the positions.

    The running sum goes by chunks, so that its cost stays near the number of matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    steps = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value"))
    )

    def inside(chunk: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))
        return F.aggregate(
            chunk,
            empty,
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.length(x["value"])).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + F.length(x["value"])).alias("end"), x["value"].alias("value"))),
                ).alias("out"),
            ),
        )

    def chunked(all_steps: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / _CHUNK).cast("int")), lambda c: inside(F.slice(all_steps, c * _CHUNK + 1, F.lit(_CHUNK))))
        placed = F.aggregate(
            chunks,
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<base:int,out:{_FOUND}>>").alias("all")),
            lambda acc, c: F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["all"], F.array(F.struct(acc["at"].alias("base"), c["out"].alias("out")))).alias("all")),
        )["all"]
        return F.flatten(
            F.transform(
                placed,
                lambda p: F.transform(p["out"], lambda s: F.struct((s["start"] + p["base"]).alias("start"), (s["end"] + p["base"]).alias("end"), s["value"].alias("value"))),
            )
        )

    return F.when(F.size(found) > 0, chunked(steps)).otherwise(F.array().cast(_FOUND))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    backward = F.reverse(number)

    def worth(i: Column) -> Column:
        digit = F.substring(backward, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p).cast("int") <= 255))
    low, high = CARD_DIGITS if kind == "card" else PHONE_DIGITS
    fits = F.length(digits(value)).between(low, high)
    return F.when(fits, luhn(digits(value))).otherwise(False) if kind == "card" else fits


def base_spans(text: Column) -> Column:
    """array of (start, rank, end, kind, value), sorted."""
    hints = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9][0-9 -]{10}"), "phone": text.rlike(r"\+[0-9]")}

    def of(rank: int, kind: str) -> Column:
        kept = F.filter(located(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
        spans = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))
        return F.when(hints[kind], spans.cast(_SPANS)).otherwise(F.array().cast(_SPANS))

    return F.array_sort(F.concat(*[of(i, k) for i, k in enumerate(KINDS, 1)]))


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def entity(span: Column) -> Column:
    plain = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"]).otherwise(digits(span["value"]))
    return F.concat_ws(":", span["kind"], plain)


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_TERM), lambda w: w != "")


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_docs) of the terms, over all documents."""
    held = docs.select(F.explode(F.array_distinct(_terms(body()))).alias("term"))
    if terms.count() <= FEW_TERMS:
        held = held.join(F.broadcast(terms), "term", "left_semi")  # FEW_TERMS words at most
        return held.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    return held.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs")).join(terms, "term", "left_semi")


def disclosing(spotted: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the terms that reach GENERALISE; spotted: a written table (row_id, text, found)."""
    spans = spotted.where(F.size("found") > 0).select("row_id", "text", F.explode("found").alias("s"))
    left = _terms(F.substring("text", F.greatest(F.col("s.start") - NEAR_CHARS, F.lit(0)) + 1, F.least(F.col("s.start"), F.lit(NEAR_CHARS))))
    right = _terms(F.substring("text", F.col("s.end") + 1, F.lit(NEAR_CHARS)))
    around = F.concat(F.reverse(F.slice(F.reverse(left), 1, NEAR)), F.array(F.lit("|")), F.slice(right, 1, NEAR))
    seen = materialise(spans.select("row_id", entity(F.col("s")).alias("entity"), around.alias("context")), "pii-contexts")

    several = seen.select("entity", "context").distinct()
    often = several.groupBy("entity").agg(F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") >= MIN_CONTEXTS)
    pairs = several.join(often.select("entity"), "entity", "left_semi").select("entity", F.explode(F.array_distinct("context")).alias("term"))
    pairs = pairs.where((F.length("term") > 1)).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("together")).where(F.col("together") >= MIN_CONTEXTS)
    pairs = materialise(pairs, "pii-pairs")
    terms = materialise(pairs.select("term").distinct(), "pii-terms")
    held = seen.select("entity", "row_id").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("holders"))
    total = docs.count()
    weighed = pairs.join(often, "entity").join(held, "entity").join(document_counts(docs, terms), "term")
    shared = F.log(F.col("together") / F.col("contexts") * total / F.col("n_docs"))
    content = F.log(F.lit(float(total)) / F.col("holders"))
    weighed = weighed.withColumn("disclosure", F.when(content > 0, F.least(F.lit(1.0), shared / content)))
    return weighed.where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure")


def term_spans(text: Column, actions: Column, base: Column) -> Column:
    """Spans of the terms in the map `actions` (term -> kind) outside the base spans."""
    hits = F.filter(located(text, TERM), lambda s: F.element_at(actions, F.lower(s["value"])).isNotNull() & ~F.exists(base, lambda b: (s["start"] < b["end"]) & (s["end"] > b["start"])))
    kind = lambda s: F.element_at(actions, F.lower(s["value"]))
    return F.transform(
        hits,
        lambda s: F.struct(
            s["start"].alias("start"), (F.when(kind(s) == GENERALISED, len(KINDS) + 1).otherwise(len(KINDS) + 2)).alias("rank"), s["end"].alias("end"), kind(s).alias("kind"), s["value"].alias("value")
        ),
    ).cast(_SPANS)


def with_spans(docs: DataFrame, keep: bool) -> DataFrame:
    """text, base and spans (base and term spans) of each row, and with keep all its columns as `doc`. Without keep only texts with spans are kept."""
    text = F.col("text") if keep else F.when(F.size("found") > 0, F.col("text"))
    spotted = docs.select(whole_row(docs) if keep else F.struct("doc_id").alias("doc"), "text", base_spans(body()).alias("found"), F.monotonically_increasing_id().alias("row_id"))
    spotted = materialise(spotted.withColumn("text", text), "pii-spotted")
    weighed = materialise(disclosing(spotted, docs), "pii-disclosing")
    action = F.when(F.col("disclosure") >= REMOVE, F.lit(REMOVED)).otherwise(F.lit(GENERALISED))
    holders = spotted.where(F.size("found") > 0).select("row_id", F.explode(F.array_distinct(F.transform("found", entity))).alias("entity"))
    # a term that several entities of a document flag is removed if one of them says so
    told = holders.join(weighed, "entity").groupBy("row_id", "term").agg(F.max(action).alias("action"))
    told = told.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("actions"))
    told = materialise(told, "pii-actions")
    out = spotted.where(F.size("found") > 0).join(told, "row_id", "left")
    more = F.when(F.col("actions").isNotNull(), term_spans(F.col("text"), F.col("actions"), F.col("found"))).otherwise(F.array().cast(_SPANS))
    out = out.select("doc", "text", F.col("found").alias("base"), F.array_sort(F.concat("found", more)).alias("spans"))
    return out.unionByName(spotted.where(F.size("found") == 0).select("doc", "text", F.col("found").alias("base"), F.col("found").alias("spans")))


def masked(text: Column, spans: Column) -> Column:
    """text with the spans under their labels; spans that overlap go together."""

    def label(s: Column) -> Column:
        number, name = s["value"].rlike(r"^[\p{N}]+$"), s["value"].rlike(r"^\p{Lu}")
        return (
            F.when(s["kind"].isin(*KINDS), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            .when(s["kind"] == REMOVED, "")
            .when(number, "[NUMBER]")
            .when(name, "[NAME]")
            .otherwise("[WORD]")
        )

    piece = "array<struct<start:int,end:int,label:string>>"

    def merge(acc: Column, s: Column) -> Column:
        out, n = acc["out"], F.size(acc["out"])
        last = F.element_at(out, -1)
        grown = F.concat(F.slice(out, F.lit(1), n - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["label"].alias("label"))))
        new = F.concat(out, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), label(s).alias("label"))))
        return F.struct(F.greatest(acc["end"], s["end"]).alias("end"), F.when((n > 0) & (s["start"] < acc["end"]), grown).otherwise(new).alias("out"))

    merged = F.aggregate(spans, F.struct(F.lit(0).alias("end"), F.array().cast(piece).alias("out")), merge)["out"]

    def rewritten(parts: Column) -> Column:
        before = F.transform(
            parts,
            lambda p, i: F.concat(
                F.substring(text, F.when(i > 0, F.get(parts, i - 1)["end"]).otherwise(0) + 1, p["start"] - F.when(i > 0, F.get(parts, i - 1)["end"]).otherwise(0)), p["label"]
            ),
        )
        end = F.element_at(parts, -1)["end"]
        return F.concat(F.array_join(before, ""), F.substring(text, end + 1, F.length(text) - end))

    return F.when(F.size(spans) > 0, rewritten(merged)).otherwise(text)


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with the spans of their texts masked."""
    clean = with_spans(docs, keep=True).withColumn("clean", masked(F.col("text"), F.col("spans")))
    return clean.select(*[F.col("clean").alias(c) if c.lower() == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


def op2_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_spans(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=False)

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc.doc_id", *[number(k) for k in KINDS], F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
