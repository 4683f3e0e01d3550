"""Printed-report dumps -> import templates. One pipeline, eight declared reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import session
from ledgerloom.functions import numbers, text
from ledgerloom.operators import matching, ordered

FILE, LINE = "source_file", "line_no"

# fixed values: marks in the printed reports
UNIT = "ใบ"
ACCOUNT = "บัญชี"
NOTE_MARK = "หมายเหตุ"
DASHES = "---------------"
EQUALS = "==============="


@dataclass(frozen=True)
class ReportSpec:
    cells: str
    titles: tuple[str, ...]
    equal_drops: tuple[tuple[str, str], ...] = ()
    start_drops: tuple[tuple[str, str], ...] = ()
    fill: str = ""
    dash: str = ""
    note: tuple[str, str, str, str, str] | None = None  # (cell, amount, settled, text before, text between)
    constants: tuple[tuple[str, str], ...] = ()
    memo: tuple[str, str, str] | None = None  # (cell, first, second)
    required: str = ""
    dropped: str = ""
    skip: int = 0
    late_start_drops: tuple[tuple[str, str], ...] = ()
    partner: str | None = None
    partner_kind: str | None = None
    late_required: tuple[str, ...] = ()
    derived: str = ""  # cells added behind the given ones, in output order


# The unnamed template column is called Blank here.
REPORTS: dict[str, ReportSpec] = {
    "1a2": ReportSpec(
        cells="DEFGHIJKL",
        equal_drops=(("L", DASHES), ("K", UNIT)),
        start_drops=(("I", "R"),),
        fill="DE",
        dash="K",
        derived="MN",
        constants=(("M", ""),),
        note=("N", "J", "K", "Invoice = ", " รับชำระแล้ว = "),
        required="FHIJKL",
        dropped="G",
        skip=2,
        titles=(
            "Partner", "Partner Code", "Invoice Date", "Payment Reference", "Sale Person", "text_1", "text_2", "Total", "Blank", "Note",
        ),
        partner="Partner Code",
        partner_kind="customer",
        late_required=("Invoice Date", "Payment Reference", "Total"),
    ),
    "116": ReportSpec(
        cells="CDEFGHIJKL",
        equal_drops=(("L", DASHES), ("L", EQUALS), ("J", UNIT)),
        start_drops=(("H", "R"),),
        fill="CD",
        dash="J",
        derived="MN",
        constants=(("M", ""),),
        note=("N", "J", "J", "AI = ", " ,ตัดชำระ = "),
        required="EFGHIJKL",
        dropped="F",
        skip=2,
        titles=(
            "Partner", "Partner Code", "Invoice Date", "Payment Reference", "Sale Person", "text_1", "text_2", "Total", "Total VAT",
            "Blank", "Note",
        ),
        late_start_drops=(("Sale Person", "VT"), ("Sale Person", "IW")),
        partner="Partner Code",
        partner_kind="customer",
        late_required=("Invoice Date", "Payment Reference", "Total"),
    ),
    "3c": ReportSpec(
        cells="CDEFGHIJKLMNOP",
        equal_drops=(("L", DASHES), ("K", UNIT)),
        fill="CD",
        derived="QR",
        constants=(("Q", "Recive Money"),),
        memo=("R", "O", "P"),
        required="EFGHIJKLMNO",
        dropped="KMOP",
        skip=1,
        titles=(
            "text_1", "text_2", "PDC Date", "Due Date", "Cheque Reference", "Bank", "Bank Branch", "Partner Code", "Amount", "Journal",
            "Payment Type", "Memo",
        ),
        partner="Partner Code",
        partner_kind="customer",
    ),
    "2a2": ReportSpec(
        cells="DEFGHIJKLM",
        equal_drops=(("M", DASHES), ("G", UNIT), ("H", UNIT)),
        fill="DE",
        dash="L",
        derived="N",
        note=("N", "K", "L", "Bill = ", " ,จ่ายชำระแล้ว = "),
        required="GHIJKLM",
        dropped="FH",
        skip=2,
        titles=("Partner", "Partner Code", "Bill Date", "Bill No", "text_1", "text_2", "text_3", "Total", "Note"),
        late_start_drops=(("text_1", "PS"), ("text_1", "PN")),
        partner="Partner Code",
        partner_kind="vendor",
    ),
    "215": ReportSpec(
        cells="DEFGHIJKLMNOPQ",
        equal_drops=(("P", DASHES), ("G", UNIT), ("I", UNIT)),
        fill="DE",
        dash="O",
        derived="RS",
        constants=(("R", ""),),
        note=("S", "N", "O", "จ่ายมัดจำ = ", " , ตัดชำระ = "),
        required="JLPQ",
        dropped="FGHIK",
        skip=1,
        titles=(
            "Partner", "Partner Code", "Invoice Date", "Payment Reference", "text_1", "text_2", "text_3", "Total", "text_4", "Blank", "Note",
        ),
        partner="Partner Code",
        partner_kind="vendor",
    ),
    "3d": ReportSpec(
        cells="CDEFGHIJKLMN",
        equal_drops=(("H", "-------------"), ("N", UNIT)),
        fill="CD",
        dash="N",
        derived="O",
        constants=(("O", "Send Money"),),
        required="EFGJK",
        dropped="HILM",
        skip=1,
        titles=(
            "text_1", "text_2", "PDC Date", "Due Date", "Cheque Reference", "Partner Code", "Memo", "PDC Amount", "Payment Type",
        ),
        partner="Partner Code",
        partner_kind="vendor",
    ),
    "tb": ReportSpec(
        cells="BCDEF",
        equal_drops=(("E", "-----------------"), ("D", ACCOUNT)),
        dash="EF",
        required="CDEF",
        dropped="D",
        skip=1,
        titles=("TB Account (Old)", "Account Name", "C/F Debit", "C/F Credit"),
    ),
}


def _equals(col: str, value: str) -> Column:
    return F.coalesce(text.strip(F.col(col)) == value, F.lit(False))


def _starts(col: str, value: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").startswith(value), F.lit(False))


def _any_present(cols: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(f"`{c}`") for c in cols]).isNotNull()


def _with_flags(df: DataFrame, cols: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Columns plus tests over many cells, as the output of a generator.

    Written as plain filters these tests become constraints over a dozen columns, and the optimizer writes
    them out for every combination of old and new column names (2^n) once the columns are renamed.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in cols], *[c.alias(n) for n, c in flags.items()])
    return df.select(F.inline(F.array(row)))


def normalize_report(
    df: DataFrame, spec: ReportSpec, mapping: DataFrame | None = None, block_size: int = 16 << 20
) -> DataFrame:
    """Template rows of a dump (cells A, B, ... with file and line), keeping source_file and line_no.

    mapping: (old, new) partner codes; IsMissing tells codes that did not change. Lines are ordered per file by
    their position; a file of any size is filled block by block.
    """
    cells = list(spec.cells)
    kept = [c for c in [*cells, *spec.derived] if c not in spec.dropped]
    # cells whose text shows in a kept column without being filled down; notes and constants never start with '='
    shown = [c for c in kept if c in cells and c not in spec.fill] + ([spec.memo[1]] if spec.memo else [])
    total = F.exists(F.array(*shown), lambda c: F.coalesce(c.startswith("="), F.lit(False)))
    flags = {"__present": _any_present(cells), "__required": _any_present(list(spec.required)), "__total": total}
    out = _with_flags(df, [FILE, LINE, *cells], flags).where("__present")
    for col, value in spec.equal_drops:
        out = out.where(~_equals(col, value))
    for col, value in spec.start_drops:
        out = out.where(~_starts(col, value))
    if spec.fill:
        blocked = ordered.position_blocks(out, LINE, block_size)
        out = ordered.forward_fill(blocked, list(spec.fill), [FILE], [LINE]).drop(ordered.BLOCK)
    for col in spec.dash:
        out = out.withColumn(col, text.zero_to_dash(F.col(col)))
    for col, value in spec.constants:
        out = out.withColumn(col, F.lit(value))
    if spec.note:
        cell, amount, settled, before, between = spec.note
        out = out.withColumn(cell, numbers.settlement_note(F.col(amount), F.col(settled), (before, between)))
    if spec.memo:
        cell, first, second = spec.memo
        head = F.coalesce(F.col(first), F.lit("nan"))
        out = out.withColumn(cell, F.when(F.col(second).isNotNull(), F.concat(head, F.lit("_"), F.col(second))).otherwise(head))
    out = out.where("__required AND NOT __total")
    for c in spec.fill:
        out = out.where(~_starts(c, "="))
    out = out.select(FILE, LINE, *kept)
    if spec.fill and spec.skip:
        # finding the first rows and leaving them out both read the filled rows
        out = session.materialise(out, "report-rows")
    out = ordered.skip_leading_rows(out, spec.skip, [FILE], [LINE])
    out = out.select(FILE, LINE, *[F.col(c).alias(t) for c, t in zip(kept, spec.titles, strict=True)])
    for title, value in spec.late_start_drops:
        out = out.where(~_starts(title, value))
    if spec.partner and mapping is not None:
        old, new = mapping.columns
        out = matching.code_map_with_missing(
            out.withColumnRenamed(spec.partner, "__code"), "__code", mapping, old, new, "IsMissing"
        ).withColumnRenamed("__code", spec.partner)
        out = out.select(FILE, LINE, *[F.col(f"`{t}`") for t in spec.titles], "IsMissing")
    if spec.late_required:
        out = _with_flags(out, out.columns, {"__late": _any_present(spec.late_required)}).where("__late").drop("__late")
    return out


@dataclass(frozen=True)
class SectionSpec:
    """A row whose key cell starts with one of the marks sets the values for the rows below it."""

    key: str = "B"
    starts: tuple[str, ...] = ("117-", "123-", "124-")
    values: dict[str, str] = field(default_factory=lambda: {"Account1": "B", "Description1": "C", "Depr": "L"})


def section_header_fill(df: DataFrame, spec: SectionSpec = SectionSpec(), block_size: int = 16 << 20) -> DataFrame:
    """Section values on every row below a header; header rows themselves get nulls."""
    header = F.lit(False)
    for start in spec.starts:
        header = header | _starts(spec.key, start)
    found = F.when(header, F.struct(*[F.col(c).alias(n) for n, c in spec.values.items()]))
    blocked = ordered.position_blocks(df, LINE, block_size)
    filled = ordered.last_known(blocked, [FILE], [LINE], {"__section": found})
    values = [F.when(~header, F.col(f"__section.{n}")).alias(n) for n in spec.values]
    return filled.select(*df.columns, *values)


def note_attach(
    df: DataFrame, mark: str = NOTE_MARK, out: str = "U", block_size: int = 16 << 20, part_chars: int = ordered.PART_CHARS
) -> DataFrame:
    """Move note lines onto the row before the note mark.

    A row whose D holds the mark opens a note; the rows below with B and C blank and text in D belong to it.
    All of them go, their D texts become the note of the row before. A mark on the first row opens nothing.
    A row takes its note's first part, `note_texts` gives all.
    """
    numbered, notes = note_parts(df, mark, block_size, part_chars)
    return _with_notes(df, numbered, notes, out)


def _with_notes(df: DataFrame, numbered: DataFrame, notes: DataFrame, out: str) -> DataFrame:
    first = notes.where("part_no = 0").select(F.col(FILE).alias("__f"), F.col("__target").alias("__row"), "__note")
    joined = numbered.where("NOT __in_note").join(first, (F.col(FILE) == F.col("__f")) & (F.col(LINE) == F.col("__row")), "left")
    return joined.select(*df.columns, F.col("__note").alias(out))


def note_texts(notes: DataFrame) -> DataFrame:
    """(file, line of the row it belongs to, part_no, note) of note_parts."""
    return notes.select(FILE, F.col("__target").alias(LINE), "part_no", F.col("__note").alias("note"))


def note_parts(
    df: DataFrame, mark: str = NOTE_MARK, block_size: int = 16 << 20, part_chars: int = ordered.PART_CHARS
) -> tuple[DataFrame, DataFrame]:
    """(rows with their place in a note, note texts with their target line, in parts).

    One pass carries down the line that began the current run, the last mark above and the line above. A row is
    in a note when a mark stands in its run; the first such mark opens it. The marked rows are written to the
    shared folder, as the notes and the remaining rows both read them.
    """

    def blank(c: str) -> Column:
        return text.strip(F.coalesce(F.col(c), F.lit(""))) == ""

    continues = blank("B") & blank("C") & ~blank("D")
    marked = F.contains(F.coalesce("D", F.lit("")), F.lit(mark))
    blocked = ordered.position_blocks(df, LINE, block_size)
    placed = ordered.last_known(
        blocked,
        [FILE],
        [LINE],
        values={"__run": F.when(~continues, F.col(LINE))},
        before={"__mark_above": F.when(marked, F.col(LINE)), "__above": F.col(LINE)},
        first={"__first": F.col(LINE)},
    )

    def counts(line: str) -> Column:
        """A mark in the current run, other than on the first line of the file."""
        run = F.coalesce("__run", "__first")
        return F.coalesce((F.col(line) >= run) & (F.col(line) > F.col("__first")), F.lit(False))

    earlier = counts("__mark_above")
    opens = marked & ~earlier & F.col("__above").isNotNull()
    numbered = placed.withColumn("__in_note", earlier | opens).withColumn("__opens", opens)
    numbered = session.materialise(numbered.drop("__mark_above", "__first"), "notes")
    notes = numbered.where("__in_note").withColumn("__run", F.coalesce("__run", F.lit(-1)))
    lines = notes.withColumn("__line", F.when(F.col("__opens"), F.lit(f"{mark}:")).otherwise(text.strip(F.col("D"))))
    targets = notes.groupBy(FILE, "__run").agg(
        F.max(F.when(F.col("__opens"), F.col("__above"))).alias("__target"), F.count(F.lit(1)).alias("__lines")
    )
    texts = ordered.ordered_text(lines, [FILE, "__run"], [LINE], "__line", "\n", "__note", part_chars).join(targets, [FILE, "__run"])
    # the mark alone still ends with a line feed
    ended = F.when(F.col("__lines") == 1, F.concat("__note", F.lit("\n"))).otherwise(F.col("__note"))
    return numbered, texts.withColumn("__note", ended).drop("__lines")


# fixed values: rows of the asset report that are no assets
_ASSET_EQUAL_DROPS = (
    ("B", "รวม"),
    ("B", "ทรัพย์สินที่ขายระหว่างงวดบัญชี"),
    ("B", "รวมทรัพย์สินที่ยังเหลืออยู่"),
    ("B", "ทรัพย์สิน"),
    ("D", "ซื้อ"),
    ("F", "ค่าเสื่อม"),
)
_ASSET_START_DROPS = (("B", "ตัวอย่าง"), ("B", "รายละเอียดค่าเสื่อมราคา"), ("B", "สำหรับงวด"))
ASSET_TITLES = {
    "Account1": "Asset Account",
    "Description1": "Asset Profile Name",
    "Depr": "Depr.Expense Account",
    "B": "Asset Code",
    "C": "Asset Name",
    "I": "Text_1",
    "N": "Asset Start Date",
    "O": "Number of Years",
    "Q": "Text_2",
    "R": "Salvage Value",
    "U": "Note",
}


def asset_report(df: DataFrame, block_size: int = 16 << 20) -> DataFrame:
    """Fixed assets (5B9): section accounts filled down, notes attached, template columns."""
    return asset_tables(df, block_size)["assets"]


def asset_tables(df: DataFrame, block_size: int = 16 << 20, part_chars: int = ordered.PART_CHARS) -> dict[str, DataFrame]:
    """The report's rows (assets), each with its note's first part, and all parts of their notes (notes: file, line, part_no, note)."""
    flags = {"__asset": _any_present(list("BCDEFGHIJ")), "__figures": _any_present(list("FGHIJ"))}
    out = section_header_fill(_with_flags(df, df.columns, flags), block_size=block_size)
    for col, value in _ASSET_EQUAL_DROPS:
        out = out.where(~_equals(col, value))
    for col, value in _ASSET_START_DROPS:
        out = out.where(~_starts(col, value))
    out = out.where("__asset AND Account1 IS NOT NULL")
    numbered, notes = note_parts(out, NOTE_MARK, block_size, part_chars)
    kept = _with_notes(out, numbered, notes, "U").where("__figures")
    assets = kept.select(FILE, LINE, *[F.col(c).alias(t) for c, t in ASSET_TITLES.items()])
    return {"assets": assets, "notes": note_texts(notes).join(kept.select(FILE, LINE), [FILE, LINE], "left_semi")}
