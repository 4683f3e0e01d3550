"""Report queries: dumps rendered from the orders, normalised into the import templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators import matching, ordered, reports
from ledgerloom.plans import adapters as ad
from ledgerloom.plans import sqlparts as q
from ledgerloom.plans.registry import query

# lines per rendered file, and per block while one file is filled
_FILE_LINES = 50_000
_BLOCK = 1 << 12


def _partner_cell(spec: reports.ReportSpec) -> str:
    kept = [c for c in [*spec.cells, *spec.derived] if c not in spec.dropped]
    return kept[spec.titles.index(spec.partner)] if spec.partner else ""


def dump(spark, sf, spec: reports.ReportSpec) -> DataFrame:
    """Report lines: group cells on every fourth line, separators, unit lines, totals and blank lines between."""
    o = ad.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    partner = _partner_cell(spec)
    kind = k % 20
    cells = []
    for i, cell in enumerate(spec.cells):
        text = F.concat(F.lit(cell), k.cast("string"))
        if cell == partner:
            text = ad.customer_code(F.col("o_custkey"))
        if cell in spec.fill:
            value = F.when(k % 4 == 3, text)
        elif cell in spec.dash:
            value = F.when(k % 5 == 0, F.lit("0.00")).when(k % 5 == 1, F.concat(k.cast("string"), F.lit(".50")))
        else:
            value = F.when((k + i) % 6 != 0, text)
        for col, start in spec.start_drops:
            if cell == col:
                value = F.when(k % 9 == 0, F.lit(start + "12")).otherwise(value)
        for n, (title, start) in enumerate(spec.late_start_drops):
            if cell == [c for c in [*spec.cells, *spec.derived] if c not in spec.dropped][spec.titles.index(title)]:
                value = F.when(k % 8 == 4 + n, F.lit(start + "9")).otherwise(value)
        for n, (col, mark) in enumerate(spec.equal_drops):
            if cell == col:
                value = F.when(kind == n, F.lit(f" {mark} ")).otherwise(value)
        if i == len(spec.cells) - 1:
            value = F.when(kind == 10, F.lit("=====")).otherwise(value)
        cells.append(F.when(kind != 11, value).alias(cell))
    file = F.concat(F.lit("F"), F.floor(k / _FILE_LINES).cast("bigint").cast("string"))
    return o.select(file.alias(reports.FILE), k.alias(reports.LINE), *cells)


def code_map(spark, sf) -> DataFrame:
    """New codes for every other customer; every seventh maps to itself."""
    k = F.col("c_custkey")
    code = ad.customer_code(k)
    # the codes of the others are of no partner
    old = F.when((k % 2 == 0) | (k % 7 == 0), code).otherwise(F.concat(F.lit("?"), code))
    new = F.when(k % 7 == 0, code).otherwise(F.concat(F.lit("N"), code))
    return ad.table(spark, sf, "customer").select(old.alias("old_code"), new.alias("new_code"))


_MAP = f"""code_map AS (SELECT CASE WHEN c_custkey % 2 = 0 OR c_custkey % 7 = 0 THEN '' ELSE '?' END || {q.code('c_custkey')} AS old_code, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'N' END || {q.code('c_custkey')} AS new_code
  FROM customer)"""
_FILE_SQL = f"'F' || CAST(o_orderkey // {_FILE_LINES} AS VARCHAR) AS source_file, o_orderkey AS line_no"


def _dump_sql(spec: reports.ReportSpec) -> str:
    partner = _partner_cell(spec)
    kept = [c for c in [*spec.cells, *spec.derived] if c not in spec.dropped]
    late = {kept[spec.titles.index(t)]: [] for t, _ in spec.late_start_drops}
    for n, (t, start) in enumerate(spec.late_start_drops):
        late[kept[spec.titles.index(t)]].append((n, start))
    out = []
    for i, cell in enumerate(spec.cells):
        whens = ["WHEN o_orderkey % 20 = 11 THEN NULL"]
        if i == len(spec.cells) - 1:
            whens.append("WHEN o_orderkey % 20 = 10 THEN '====='")
        for n, (col, mark) in reversed(list(enumerate(spec.equal_drops))):
            if col == cell:
                whens.append(f"WHEN o_orderkey % 20 = {n} THEN ' {mark} '")
        for n, start in reversed(late.get(cell, [])):
            whens.append(f"WHEN o_orderkey % 8 = {4 + n} THEN '{start}9'")
        for col, start in spec.start_drops:
            if col == cell:
                whens.append(f"WHEN o_orderkey % 9 = 0 THEN '{start}12'")
        text = q.code("o_custkey") if cell == partner else f"'{cell}' || CAST(o_orderkey AS VARCHAR)"
        if cell in spec.fill:
            whens.append(f"WHEN o_orderkey % 4 = 3 THEN {text}")
        elif cell in spec.dash:
            whens.append("WHEN o_orderkey % 5 = 0 THEN '0.00' WHEN o_orderkey % 5 = 1 THEN CAST(o_orderkey AS VARCHAR) || '.50'")
        else:
            whens.append(f"WHEN (o_orderkey + {i}) % 6 <> 0 THEN {text}")
        out.append(f'CASE {" ".join(whens)} END AS "{cell}"')
    return f"raw AS (SELECT {_FILE_SQL}, {', '.join(out)} FROM orders)"


def _present(cols) -> str:
    quoted = ", ".join(f'"{c}"' for c in cols)
    return f"coalesce({quoted}) IS NOT NULL" if len(cols) > 1 else f"{quoted} IS NOT NULL"


def report_sql(spec: reports.ReportSpec) -> str:
    kept = [c for c in [*spec.cells, *spec.derived] if c not in spec.dropped]
    no_marks = [f"coalesce(trim({c}), 'x') <> '{v}'" for c, v in spec.equal_drops]
    no_starts = [f"NOT starts_with(coalesce({c}, 'x'), '{v}')" for c, v in spec.start_drops]
    f0 = f"f0 AS (SELECT * FROM raw WHERE {' AND '.join([_present(spec.cells), *no_marks, *no_starts])})"
    fills = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS {c}" for c in spec.fill
    )
    f1 = f"f1 AS (SELECT * {f'REPLACE ({fills})' if fills else ''} FROM f0)"
    dashes = ", ".join(f"CASE WHEN TRY_CAST({c} AS DOUBLE) = 0 THEN '-' ELSE {c} END AS {c}" for c in spec.dash)
    f2 = f"f2 AS (SELECT * {f'REPLACE ({dashes})' if dashes else ''} FROM f1)"
    derived = [f"'{v}' AS {c}" for c, v in spec.constants]
    if spec.note:
        c, amount, settled, before, between = spec.note
        derived.append(
            f"CASE WHEN {settled} = '-' THEN '' ELSE '{before}' || coalesce({amount}, 'nan') || '{between}' || coalesce({settled}, 'nan') END AS {c}"
        )
    if spec.memo:
        c, first, second = spec.memo
        derived.append(f"coalesce({first}, 'nan') || CASE WHEN {second} IS NOT NULL THEN '_' || {second} ELSE '' END AS {c}")
    f3 = f"f3 AS (SELECT {', '.join(['*', *derived])} FROM f2)"
    no_totals = [f"NOT starts_with(coalesce({c}, 'x'), '=')" for c in kept]
    f4 = f"""f4 AS (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY line_no) AS rn FROM f3
      WHERE {' AND '.join([_present(spec.required), *no_totals])})"""
    names = ", ".join(f'{c} AS "{t}"' for c, t in zip(kept, spec.titles, strict=True))
    f5 = f"f5 AS (SELECT source_file, line_no, {names} FROM f4 WHERE rn > {spec.skip})"
    late = [f"NOT starts_with(coalesce(\"{t}\", 'x'), '{v}')" for t, v in spec.late_start_drops]
    if spec.late_required:
        late.append(_present(spec.late_required))
    where = f"WHERE {' AND '.join(late)}" if late else ""
    head = f"WITH {_dump_sql(spec)}, {f0}, {f1}, {f2}, {f3}, {f4}, {f5}"
    if not spec.partner:
        return f"{head} SELECT * FROM f5 {where}"
    p = f'"{spec.partner}"'
    return f"""{head}, {_MAP} SELECT f5.* REPLACE (coalesce(m.new_code, f5.{p}) AS {p}),
      coalesce(coalesce(m.new_code, f5.{p}) = f5.{p}, false) AS "IsMissing" FROM f5 LEFT JOIN code_map m ON f5.{p} = m.old_code {where}"""


def _register(name: str, spec: reports.ReportSpec) -> None:
    @query(f"report_{name}", report_sql(spec))
    def run(spark, sf):
        mapping = code_map(spark, sf) if spec.partner else None
        return reports.normalize_report(dump(spark, sf, spec), spec, mapping, _BLOCK)


for _name, _spec in reports.REPORTS.items():
    _register(_name, _spec)


def asset_dump(spark, sf) -> DataFrame:
    """Asset report lines: section headers, totals, assets, and notes of none to two lines."""
    o = ad.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    t = k.cast("string")
    kind = k % 15
    asset = ~kind.isin(0, 1, 5, 6, 7)
    more = (kind == 6) | ((kind == 7) & (k % 2 == 0))
    plain = asset | ((kind == 7) & (k % 2 == 1))
    cells = {c: F.when(plain, F.concat(F.lit(c), t)) for c in "EFGHIJKMNOPQR"}
    cells["A"] = F.lit(None).cast("string")
    cells["B"] = (
        F.when(kind == 0, F.concat(ad.pick(["117-", "123-", "124-"], k % 3), t)).when(kind == 1, F.lit(" รวม ")).when(plain, F.concat(F.lit("A"), t))
    )
    cells["C"] = F.when(kind == 0, F.concat(F.lit("section "), t)).when(plain, F.concat(F.lit("asset "), t))
    cells["D"] = F.when(kind == 5, F.lit(" หมายเหตุ ")).when(more, F.concat(F.lit("  line "), t)).when(plain, F.lit("D"))
    cells["L"] = F.when(kind == 0, F.concat(F.lit("dep "), t)).when(plain, F.lit("L"))
    file = F.concat(F.lit("F"), F.floor(k / _FILE_LINES).cast("bigint").cast("string"))
    return o.select(file.alias(reports.FILE), k.alias(reports.LINE), *[cells[c].alias(c) for c in "ABCDEFGHIJKLMNOPQR"])


_K, _P = "CAST(o_orderkey AS VARCHAR)", "(o_orderkey % 15 NOT IN (0, 1, 5, 6, 7) OR (o_orderkey % 15 = 7 AND o_orderkey % 2 = 1))"
_ASSETS = f"""raw AS (SELECT {_FILE_SQL}, CAST(NULL AS VARCHAR) AS "A",
    CASE WHEN o_orderkey % 15 = 0 THEN ['117-','123-','124-'][o_orderkey % 3 + 1] || {_K} WHEN o_orderkey % 15 = 1 THEN ' รวม ' WHEN {_P} THEN 'A' || {_K} END AS "B",
    CASE WHEN o_orderkey % 15 = 0 THEN 'section ' || {_K} WHEN {_P} THEN 'asset ' || {_K} END AS "C",
    CASE WHEN o_orderkey % 15 = 5 THEN ' หมายเหตุ ' WHEN {_P} THEN 'D' WHEN o_orderkey % 15 IN (6, 7) THEN '  line ' || {_K} END AS "D",
    {", ".join(f"CASE WHEN {_P} THEN '{c}' || {_K} END AS {c}" for c in "EFGHIJKMNOPQR")},
    CASE WHEN o_orderkey % 15 = 0 THEN 'dep ' || {_K} WHEN {_P} THEN 'L' END AS "L" FROM orders)"""
_HEADER = "(starts_with(coalesce(B, 'x'), '117-') OR starts_with(coalesce(B, 'x'), '123-') OR starts_with(coalesce(B, 'x'), '124-'))"
_WIN = "OVER (PARTITION BY source_file ORDER BY line_no ROWS UNBOUNDED PRECEDING)"
_SECTIONS = f"""sections AS (SELECT *, {_HEADER} AS h,
    CASE WHEN NOT {_HEADER} THEN last_value(CASE WHEN {_HEADER} THEN B END IGNORE NULLS) {_WIN} END AS Account1,
    CASE WHEN NOT {_HEADER} THEN last_value(CASE WHEN {_HEADER} THEN C END IGNORE NULLS) {_WIN} END AS Description1,
    CASE WHEN NOT {_HEADER} THEN last_value(CASE WHEN {_HEADER} THEN L END IGNORE NULLS) {_WIN} END AS Depr FROM raw)"""


def _notes(source: str) -> str:
    return f"""numbered AS (SELECT *, row_number() {_WIN} AS rn,
      sum(CASE WHEN trim(coalesce(B, '')) = '' AND trim(coalesce(C, '')) = '' AND trim(coalesce(D, '')) <> '' THEN 0 ELSE 1 END) {_WIN} AS seg FROM {source}),
    opened AS (SELECT *, min(CASE WHEN contains(D, 'หมายเหตุ') AND rn > 1 THEN rn END) OVER (PARTITION BY source_file, seg) AS opener FROM numbered),
    notes AS (SELECT source_file, opener, 'หมายเหตุ:' || chr(10) || coalesce(string_agg(trim(D), chr(10) ORDER BY rn) FILTER (rn > opener), '') AS note
      FROM opened WHERE rn >= opener GROUP BY source_file, opener),
    noted AS (SELECT o.*, n.note AS U FROM opened o LEFT JOIN notes n ON n.source_file = o.source_file AND n.opener - 1 = o.rn
      WHERE o.opener IS NULL OR o.rn < o.opener)"""


@query("section_header_fill", f"WITH {_ASSETS}, {_SECTIONS} SELECT source_file, line_no, B, Account1, Description1, Depr FROM sections")
def section_header_fill(spark, sf):
    out = reports.section_header_fill(asset_dump(spark, sf), block_size=_BLOCK)
    return out.select(reports.FILE, reports.LINE, "B", "Account1", "Description1", "Depr")


@query("note_attach", f"WITH {_ASSETS}, {_notes('raw')} SELECT source_file, line_no, B, C, D, U FROM noted")
def note_attach(spark, sf):
    cells = asset_dump(spark, sf).select(reports.FILE, reports.LINE, "B", "C", "D")
    return reports.note_attach(cells, block_size=_BLOCK)


_KEPT_ASSETS = f"""{_ASSETS}, {_SECTIONS}, kept AS (SELECT * FROM sections WHERE coalesce(trim(B), 'x') <> 'รวม' AND coalesce(B, C, D, E, F, G, H, I, J) IS NOT NULL
      AND Account1 IS NOT NULL), {_notes('kept')}"""


@query(
    "report_5b9",
    f"""WITH {_KEPT_ASSETS}
    SELECT source_file, line_no, {", ".join(f'{c} AS "{t}"' for c, t in reports.ASSET_TITLES.items())} FROM noted WHERE coalesce(F, G, H, I, J) IS NOT NULL""",
)
def report_5b9(spark, sf):
    return reports.asset_report(asset_dump(spark, sf), _BLOCK)


@query(
    "report_5b9_notes",
    f"""WITH {_KEPT_ASSETS}
    SELECT source_file, line_no, CAST(0 AS INTEGER) AS part_no, U AS note FROM noted WHERE coalesce(F, G, H, I, J) IS NOT NULL AND U IS NOT NULL""",
)
def report_5b9_notes(spark, sf):
    return reports.asset_tables(asset_dump(spark, sf), _BLOCK)["notes"]


_PLAIN = reports.REPORTS["1a2"]


@query(
    "forward_fill",
    f"""WITH {_dump_sql(_PLAIN)} SELECT source_file, line_no, last_value(D IGNORE NULLS) {_WIN} AS D, last_value(E IGNORE NULLS) {_WIN} AS E, H FROM raw""",
)
def forward_fill(spark, sf):
    cells = dump(spark, sf, _PLAIN).select(reports.FILE, reports.LINE, "D", "E", "H")
    blocked = ordered.position_blocks(cells, reports.LINE, _BLOCK)
    return ordered.forward_fill(blocked, ["D", "E"], [reports.FILE], [reports.LINE]).drop(ordered.BLOCK)


@query(
    "skip_leading_rows",
    f"""WITH {_dump_sql(_PLAIN)} SELECT source_file, line_no, H FROM (SELECT *, row_number() {_WIN} AS rn FROM raw WHERE H IS NOT NULL) WHERE rn > 3""",
)
def skip_leading_rows(spark, sf):
    cells = dump(spark, sf, _PLAIN).select(reports.FILE, reports.LINE, "H").where("H IS NOT NULL")
    return ordered.skip_leading_rows(cells, 3, [reports.FILE], [reports.LINE])


@query(
    "code_map_with_missing",
    f"""WITH {q.ARTRN}, {_MAP} SELECT a.docnum, coalesce(m.new_code, a.cuscod) AS cuscod, coalesce(m.new_code, a.cuscod) = a.cuscod AS is_missing
    FROM artrn a LEFT JOIN code_map m ON a.cuscod = m.old_code""",
)
def code_map_with_missing(spark, sf):
    docs = ad.artrn(spark, sf).select("docnum", "cuscod")
    return matching.code_map_with_missing(docs, "cuscod", code_map(spark, sf), "old_code", "new_code")
