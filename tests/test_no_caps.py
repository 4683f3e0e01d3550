"""What used to be capped, cut or dropped: long texts, many blocks, long order values, wide rows, differing files, rows outside a range."""

from __future__ import annotations

import datetime as dt
import os
import time
from decimal import Decimal as D

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from ledgerloom import session, sinks
from ledgerloom.functions import numbers, text
from ledgerloom.operators import ledger, ordered, pages, reports
from ledgerloom.plans import jobs, staging
from ledgerloom.schemas import conform, struct
from ledgerloom.sources import dbf, files, lines


def test_all_parts_of_a_remark_reach_the_header(frame):
    remarks = frame("docnum string, seqnum string, remark string, line_no long", [("IV1", str(i), f"note {i}", i) for i in range(30)] + [("IV2", "1", "//123456", 1)])
    parts = ledger.remark_consolidate(remarks, part_chars=20)
    assert parts.where("docnum = 'IV1'").count() > 5
    docs = frame("docnum string, remark string, so_number string", [("IV1", None, None), ("IV2", None, None), ("IV3", None, None)])
    got = {r.docnum: (r.remark, r.remark_parts, r.so_number) for r in ledger.remark_enrich(docs, parts).collect()}
    whole = {r.docnum: r.remark for r in ledger.remark_enrich(docs, ledger.remark_consolidate(remarks)).collect()}
    texts = [r.remark for r in parts.where("docnum = 'IV1'").orderBy("part_no").collect()]
    assert "|".join(texts) == whole["IV1"] and whole["IV1"].count("note") == 30
    assert got == {"IV1": (texts[0], len(texts), None), "IV2": (None, 0, "SO123456"), "IV3": (None, 0, None)}


def test_all_credit_numbers_reach_the_invoice(frame):
    invoices = frame("docnum string, total decimal(18,2)", [("IV001", D(100)), ("IV002", D(5))])
    credits = frame("docnum string, total decimal(18,2), line_no long", [(f"SC001-{i}", D(1), i) for i in range(20)])
    rows = ledger.invoice_credit_netting(invoices, credits, part_chars=10).collect()
    parts = ledger.credit_references(invoices, credits, part_chars=10).orderBy("part_no").collect()
    assert ",".join(r.debit_note_refs for r in parts) == ",".join(f"SC001-{i}" for i in range(20)) and {r.docnum for r in parts} == {"IV001"}
    got = {r.docnum: (r.debit_note_refs, r.debit_note_parts, r.credit_total) for r in rows}
    assert got == {"IV001": (parts[0].debit_note_refs, len(parts), D(20)), "IV002": (None, 0, D(0))} and len(parts) > 5


def test_dealer_invoices_hold_all_their_credit_numbers(frame):
    day = dt.date(1998, 5, 1)
    docs = [("IV001", day, "1-01", 0), ("IV002", day, "1-02", 1), *[(f"SC001-{c * 600_000}", day, "1-01", 2 + i) for i, c in enumerate("CAB")]]
    docs = frame("docnum string, docdat date, cuscod string, line_no long", docs).withColumns({"amount": F.lit(9).cast("decimal(15,2)"), "disc": F.lit(0), "total": F.lit(7).cast("decimal(15,2)")})
    customers, target = frame("cuscod string, cusnam string", [("1-01", "A")]), frame("doc_number string", [("IV009",)])
    made = jobs.dealer_invoices(docs, customers, target, dt.date(1998, 1, 1), dt.date(1998, 12, 31))
    assert made["references"].count() == 2
    whole = ",".join(f"SC001-{c * 600_000}" for c in "CAB")
    got = {r.doc_number: (r.net_total, r.debit_note_refs == whole, r.debit_note_refs is None) for r in made["invoice"].collect()}
    assert got == {"IV001": (D(-14), True, False), "IV002": (D(7), False, True)}
    assert "debit_note_parts" not in made["invoice"].columns


def test_all_parts_of_a_note_reach_its_row(frame):
    rows = [("a", "b", "c", "d", 0), ("a", "", "", f"x {reports.NOTE_MARK}", 1)] + [("a", "", "", f"line {i}", i) for i in range(2, 40)] + [("a", "b", "c", "e", 40)]
    df = frame("source_file string, B string, C string, D string, line_no long", rows).withColumn("file_no", F.lit(0))
    names = [c for c in (reports.FILE, reports.LINE)]
    assert set(names) <= set(df.columns)
    got = [r.U for r in reports.note_attach(df, part_chars=12).orderBy("line_no").collect()]
    want = [r.U for r in reports.note_attach(df).orderBy("line_no").collect()]
    parts = [r.note for r in reports.note_texts(reports.note_parts(df, part_chars=12)[1]).where("line_no = 0").orderBy("part_no").collect()]
    assert "\n".join(parts) == want[0] and want[0].count("line") == 38 and got == [parts[0], None] == [parts[0], want[1]]


NOTES = [c * 600_000 for c in "CAB"]


def _ledger_job(frame):
    """Tables of a job with one invoice whose remark takes two parts, and one without a remark."""
    money, day = "decimal(15,2)", dt.date(1998, 5, 1)
    docs = frame(
        f"docnum string, docdat date, sonum string, cuscod string, bilnum string, amount {money}, total {money}, remamt {money}, docstat string, dlvby string, duedat date, line_no long",
        [(n, day, None, "1-01", "B1", D(9), D(7), D(0), "N", "x", day, i) for i, n in enumerate(["IV1", "IV2"])],
    )
    remarks = frame("docnum string, seqnum string, line_no long, remark string", [*[("IV1", str(i), i, n) for i, n in enumerate(NOTES)], ("IV2", "1", 9, "//123456")])
    lines = frame(
        f"docnum string, docdat date, seqnum int, stkcod string, stkdes string, people string, flag string, trnqty {money}, unitpr {money}, disc string, trnval {money}, pos long",
        [("IV1", day, 1, "s1", "d", "p", "N", D(2), D(3), "", D(6), 1)],
    )
    customers, areas = frame("cuscod string, cusnam string, paytrm int", [("1-01", "A", 30)]), frame("sale_area string, cuscod_startwith string", [("Z", "1")])
    products, listed = frame(f"stkcod string, unitpr {money}", [("s1", D(2))]), frame("stkcod string", [("s9",)])
    return jobs.invoice_ledger(docs, remarks, lines, customers, areas, products, listed, dt.date(1998, 1, 1), dt.date(1998, 12, 31), ["pos"])


def test_headers_of_the_invoice_ledger_hold_whole_remarks(frame):
    made = _ledger_job(frame)
    assert made["remark"].count() == 2
    got = {r.doc_number: (r.remark, r.so_number, r.cost_total) for r in made["header"].collect()}
    assert got == {"IV1": (" | ".join(NOTES), None, D(4)), "IV2": (None, "SO123456", None)}
    assert "remark_parts" not in made["header"].columns


def _many_documents(frame):
    """Tables of a job with invoices of shared base numbers, credit notes, null numbers, and SKUs that no product has."""
    money, day = "decimal(15,2)", dt.date(1998, 5, 1)
    numbers = [f"{kind}{i:07d}{end}" for i in range(12) for kind, end in (("IV", ""), ("OL", "-2"), ("SR", "-1"))] + [None]
    docs = frame(
        f"docnum string, docdat date, sonum string, cuscod string, bilnum string, amount {money}, total {money}, remamt {money}, docstat string, dlvby string, duedat date, line_no long",
        [(n, day, n and f"IV{n[2:9]}" if i % 3 == 2 else None, "1-01", f"B{i % 4}", D(9), D(7), D(0), "N", "x", day, i) for i, n in enumerate(numbers)],
    )
    remarks = frame("docnum string, seqnum string, line_no long, remark string", [(n, str(j), i, f"r{j} //{i})") for i, n in enumerate(numbers) for j in range(3)])
    lines = frame(
        f"docnum string, docdat date, seqnum int, stkcod string, stkdes string, people string, flag string, trnqty {money}, unitpr {money}, disc string, trnval {money}, pos long",
        [(n, day, j, f"s{(i + j) % 3}" if j else None, "d", "p", "N", D(2 + j), D(j % 2), "", D(6), 10 * i + j) for i, n in enumerate([*numbers, "IV9"]) for j in range(5)],
    )
    customers, areas = frame("cuscod string, cusnam string, paytrm int", [("1-01", "A", 30)]), frame("sale_area string, cuscod_startwith string", [("Z", "1")])
    products, listed = frame(f"stkcod string, unitpr {money}", [("s1", D(2)), ("s2", None), ("s7", D(1))]), frame("stkcod string", [("s0",)])
    return jobs.invoice_ledger(docs, remarks, lines, customers, areas, products, listed, dt.date(1998, 1, 1), dt.date(1998, 12, 31), ["pos"])


def test_slices_of_a_ledger_make_the_same_tables(frame, monkeypatch):
    whole = {name: sorted(map(str, rows.collect())) for name, rows in _many_documents(frame).items()}
    assert len(whole["header"]) == 24 and len(whole["detail"]) == 120 and len(whole["credit_detail"]) == 60
    monkeypatch.setattr(jobs, "SLICE_ROWS", 20)
    made = _many_documents(frame)
    assert {name: sorted(map(str, rows.collect())) for name, rows in made.items()} == whole
    # headers with lines that another table has made already
    made = _many_documents(frame)
    assert sorted(map(str, made["detail"].collect())) == whole["detail"] and sorted(map(str, made["header"].collect())) == whole["header"]


def test_a_ledger_keeps_no_shuffles_and_no_lines_of_a_slice(spark, frame, monkeypatch):
    def shuffled():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    docs = frame("k int, v string", [(i % 7, f"v{i}") for i in range(2000)])
    before = shuffled()
    with session.tracked() as kept:
        session.materialise(docs.repartition(8, "k").groupBy("v").count(), "counted")
    until = time.time() + 20
    while shuffled() > before and time.time() < until:
        time.sleep(0.2)
    assert shuffled() <= before
    session.drop_tables(spark, kept)

    monkeypatch.setattr(jobs, "SLICE_ROWS", 20)
    with session.tracked() as kept:
        made = _many_documents(frame)
        assert made["detail"].count() == 120 and made["header"].count() == 24
    left = sorted(os.path.basename(p).rsplit("-", 1)[0] for p in kept if os.path.isdir(p.removeprefix("file:")))
    assert left == ["costs", "credits", "detail", "invoices", "numbers", "numbers", "texts"]
    session.drop_tables(spark, kept)


def test_lines_of_a_base_number_stay_together_in_slices(spark, frame, monkeypatch):
    """Numbers of eight digits share a base number of seven: credits go to the lines in order, whichever of its documents they stand in."""
    monkeypatch.setattr(jobs, "SLICE_ROWS", 5)
    money, day = "decimal(15,2)", dt.date(1998, 5, 1)
    numbers = [f"{kind}{i}" for i in range(10_000_000, 10_000_040) for kind in ("IV", "SR")]
    docs = frame(
        f"docnum string, docdat date, sonum string, cuscod string, bilnum string, amount {money}, total {money}, remamt {money}, docstat string, dlvby string, duedat date, line_no long",
        [(n, day, f"IV{n[2:]}", "1-01", "B", D(9), D(7), D(0), "N", "x", day, i) for i, n in enumerate(numbers)],
    )
    lines = frame(
        f"docnum string, docdat date, seqnum int, stkcod string, stkdes string, people string, flag string, trnqty {money}, unitpr {money}, disc string, trnval {money}, pos long",
        [(n, day, 1, "s1", "d", "p", "N", D(3) if n < "SR" else D(1), D(5), "", D(6), i) for i, n in enumerate(numbers)],
    )
    none = frame("docnum string, seqnum string, line_no long, remark string", [])
    customers, areas = frame("cuscod string, cusnam string, paytrm int", [("1-01", "A", 30)]), frame("sale_area string, cuscod_startwith string", [("Z", "1")])
    products, listed = frame(f"stkcod string, unitpr {money}", [("s1", D(2)), ("s1", D(2)), ("s2", D(1))]), frame("stkcod string", [("s9",)])
    with session.tracked() as kept:
        made = jobs.invoice_ledger(docs, none, lines, customers, areas, products, listed, dt.date(1998, 1, 1), dt.date(1998, 12, 31), ["pos"])
        got = [(r.doc_number, r.qty_sc_sr_deducted, r.qty_balance, r.cost) for r in made["detail"].orderBy("doc_number").collect()]
    want = []
    for group in range(4):  # ten invoices of three each, credited ten times one
        left = 10
        for i in range(10):
            took = min(3, left)
            left -= took
            want += 2 * [(f"IV{10_000_000 + 10 * group + i}", D(took), D(3 - took), D(2))]  # a product that stands twice gives two rows, as ever
    assert got == want
    left = sorted(os.path.basename(p).rsplit("-", 1)[0] for p in kept if os.path.isdir(p.removeprefix("file:")))
    assert left == ["costs", "credits", "detail", "invoices", "numbers", "numbers"]
    session.drop_tables(spark, kept)


def test_refreshed_headers_hold_whole_remarks(frame):
    header = _ledger_job(frame)["header"]
    known = header.where("doc_number = 'IV1'").withColumns({"doc_date": F.date_sub("doc_date", 4000), "remark": F.lit("old")})
    merged = jobs.merged_headers(known, header, dt.date(1998, 1, 1), dt.date(1998, 12, 31))
    got = {r.doc_number: (r.doc_date.year, r.remark) for r in merged.collect()}
    assert got == {"IV1": (1987, " | ".join(NOTES)), "IV2": (1998, None)}
    assert "remark_parts" not in merged.columns


def test_whole_text_keeps_empty_parts_between_separators(frame):
    remarks = frame("docnum string, seqnum string, remark string, line_no long", [("A", "1", "send", 1), ("A", "2", "//123456", 2), ("B", "1", "//123456", 1)])
    docs = frame("docnum string", [("A",), ("B",), ("C",)])
    for chars in (1, 3, 100):
        texts = ledger.remark_consolidate(remarks, part_chars=chars)
        assert {r.docnum: r.remark for r in ledger.remark_enrich(docs, texts, whole=True).collect()} == {"A": "send |", "B": None, "C": None}


def test_more_than_256_blocks(frame):
    df = frame("k string, pos int", [("hot", i) for i in range(3000)])
    blocked = ordered.quantile_blocks(df, ["pos"], 600)
    assert blocked.select(ordered.BLOCK).distinct().count() > 500
    got = ordered.row_numbers(blocked, ["k"], ["pos"], "n")
    assert got.where("n != pos + 1").count() == 0


def test_order_values_with_a_long_common_start(frame):
    start = "/very/long/common/beginning/of/all/paths/"
    rows = [("k", start * (i % 2) + f"{i:04d}", i % 7) for i in range(400)] + [("k", start + "same", i) for i in range(200)] + [("k", None, 1)]
    df = frame("k string, path string, pos int", rows)
    blocked = ordered.quantile_blocks(df, ["path", "pos"], 16)
    sizes = [r["count"] for r in blocked.groupBy(ordered.BLOCK).count().collect()]
    assert len(sizes) > 10 and max(sizes) < 120
    got = [r.n for r in ordered.row_numbers(blocked, ["k"], ["path", "pos"], "n").orderBy("path", "pos").collect()]
    assert got == list(range(1, 602))


def test_blocks_of_a_frame_with_longer_texts_than_the_bounds(frame):
    short = frame("k string, name string", [("k", c * 3) for c in "abcdefgh"])
    long = frame("k string, name string", [("k", c * n) for c in "abcdefgh" for n in (1, 3, 9, 40)])
    blocked = ordered.quantile_blocks(long, ["name"], 4, bounds_from=short)
    got = [r.n for r in ordered.row_numbers(blocked, ["k"], ["name"], "n").orderBy("name").collect()]
    assert got == list(range(1, 33))


def test_cuts_are_values_of_any_type_and_length(frame, spark):
    long = "x" * 100_000
    rows = [(long if i == 3 else f"n{i % 50:02d}", None if i % 9 == 0 else float("nan") if i % 9 == 1 else i / 7, dt.datetime(2024, 1, 1, i % 24, i % 60), i % 5 == 0, D(i * 10**20), i) for i in range(400)]
    df = frame("name string, x double, ts timestamp, b boolean, d decimal(30,2), pos int", rows).withColumn("both", F.struct("b", F.col("ts").cast("timestamp_ntz").alias("at")))
    df = df.withColumn("day", F.to_date("ts")).withColumn("raw", F.encode("name", "utf-8"))
    for order in (["name", "pos"], ["x", "pos"], ["ts", "d"], ["both", "pos"], ["b", "x", "d"], ["day", "raw", "pos"], ["d"]):
        blocked = ordered.quantile_blocks(df, order, 12)
        got = [r[0] for r in blocked.orderBy(*order).select(ordered.BLOCK).collect()]
        assert got == sorted(got) and len(set(got)) > 8, order
    cuts = ordered.find_cuts(df, ["name", "pos"], 400)
    assert max(len(c[0] or "") for c in cuts) < 10


def test_a_long_order_value_does_not_slow_the_others(frame):
    df = frame("k string, name string, pos int", [("hot", "y" * 100_000 if i == 7 else f"n{i:04d}", i) for i in range(1000)])
    got = ordered.row_numbers(ordered.quantile_blocks(df, ["name"], 8), ["k"], ["name"], "n")
    assert [r.n for r in got.orderBy("name").collect()] == list(range(1, 1001))


def test_cuts_stop_at_the_first_difference():
    assert ordered._shortest(("abc", 5), ("abdef", 7)) == ("abd", None)
    assert ordered._shortest(("ab", 5), ("abdef", 7)) == ("abd", None)
    assert ordered._shortest((None, 5), ("abdef", 7)) == ("abdef", None)
    assert ordered._shortest(("a", 5), ("a", 7)) == ("a", 7)
    assert ordered._shortest((float("nan"), 1), (float("nan"), 2))[1] == 2


def test_reports_of_any_width(spark, tmp_path):
    assert lines.cell_names(28)[-3:] == ["Z", "AA", "AB"]
    (tmp_path / "w.csv").write_text(",".join(map(str, range(30))) + "\n")
    row = lines.report_csv_scan(spark, str(tmp_path / "w.csv"), 0, 30).first()
    assert (row.A, row.Z, row.AD) == ("0", "25", "29")


def test_sheets_with_titles_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n" * 4 + "x" * 200_000 + "\nSKU,จำนวน,ราคาสินค้า/ชิ้น\n1,2,3\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("\n" * 5 + "ราคาสินค้า/ชิ้น,more,จำนวน,SKU\n6,-,5,4\n", encoding="utf-8")
    rows = lines.sheet_lines_scan(spark, {"s": str(tmp_path)}).collect()
    assert sorted((r.sku, r.quantity, r.unit_price) for r in rows) == [("1", 2, 3.0), ("4", 5, 6.0)]


def _ledger_file(path, fields, records):
    path.write_bytes(staging.dbf_header(fields, len(records)) + b"".join(staging.dbf_record(r, fields, False) for r in records) + b"\x1a")


def test_fields_of_all_files_count(spark, tmp_path):
    _ledger_file(tmp_path / "a.dbf", [("DOC", "C", 4, 0), ("AMT", "N", 6, 0)], [("A1", "12")])
    _ledger_file(tmp_path / "b.dbf", [("DOC", "C", 4, 0), ("AMT", "N", 12, 2), ("LATE", "C", 3, 0)], [("B1", "1234567.25", "new")])
    rows = dbf.dbf_scan(spark, [str(tmp_path / "a.dbf"), str(tmp_path / "b.dbf")]).orderBy("file_no").collect()
    assert [(r.doc, r.amt, r.late) for r in rows] == [("A1", D("12.00"), None), ("B1", D("1234567.25"), "new")]


def test_blank_dates_are_in_no_range(spark, tmp_path):
    fields = [("DOC", "C", 4, 0), ("DAY", "D", 8, 0)]
    _ledger_file(tmp_path / "a.dbf", fields, [("A1", "20240101"), ("A2", ""), ("A3", "20250101")])
    _ledger_file(tmp_path / "b.dbf", fields[:1], [("B1",)])
    df = dbf.dbf_scan(spark, str(tmp_path), ["DOC"], date_field="DAY", end=dt.date(2024, 12, 31))
    assert [r.doc for r in df.collect()] == ["A1"]


def test_rows_outside_a_replaced_range_stay(spark, frame, tmp_path):
    d = dt.date
    path = str(tmp_path / "t")
    old = [("jan", d(2024, 1, 5)), ("feb", d(2024, 2, 5)), ("apr", d(2024, 4, 5)), ("none", None)]
    sinks.write_months(frame("v string, doc_date date", old), path, "doc_date")
    new = frame("v string, doc_date date", [("feb2", d(2024, 2, 6)), ("apr2", d(2024, 4, 6)), ("none2", None)])
    sinks.replace_date_range_write(spark, path, new, "doc_date", d(2024, 2, 1), d(2024, 2, 20), str(tmp_path / "s"))
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["apr", "apr2", "feb2", "jan", "none", "none2"]


def test_unknown_schemes_are_refused():
    for path in ("dbfs:/x", "wasbs://a@b/c"):
        with pytest.raises(ValueError, match="no reader"):
            files.file_system(path)
    assert files.file_system("file:/a/b")[1] == files.file_system("file:///a/b")[1] == "/a/b"


def test_opacity_words_with_a_no_break_space(frame):
    assert frame("c string", [("Black Out X1",)]).select(text.fabric_code(F.col("c"))).first()[0] == "X1"


def test_numeric_entities(frame):
    rows = [("caf&#233; &#xE9;&#X1F600; &amp;#39; &#39; &#0; &#; &#55296; &lt;a&gt;&nbsp;&#",), ("plain",), (None,)]
    got = [r[0] for r in frame("c string", rows).select(pages.unescape(F.col("c"))).collect()]
    assert got == ["café é😀 &#39; ' \ufffd &#; \ufffd <a>\u00a0&#", "plain", None]


def test_amounts_beyond_the_type_are_errors(frame):
    df = frame("c string", [("99999999999999.50",)])
    with pytest.raises(ArithmeticException):
        df.select(numbers.numeric_or_zero(F.col("c"))).collect()
    assert frame("c string", [("x",), ("1.005",)]).select(numbers.numeric_or_zero(F.col("c")).alias("v")).collect() == [(D("0.00"),), (D("1.01"),)]
    with pytest.raises(ArithmeticException):
        conform(frame("a decimal(30,2)", [(D("99999999999999.50"),)]), struct("a money")).collect()


def test_price_and_credit_rules_of_the_order_ledger(frame):
    docs = frame(
        "docnum string, docdat date, sonum string, cuscod string, amount decimal(15,2), total decimal(15,2), docstat string, duedat date, bilnum string",
        [(n, dt.date(2024, 1, 1), so, "31", D(1), D(1), "", None, None) for n, so in (("OL001", ""), ("SL009", "001"), ("SL001-A", "777"))],
    )
    lines_ = frame(
        "docnum string, docdat date, seqnum int, stkcod string, stkdes string, people string, flag string, trnqty decimal(15,2), unitpr decimal(15,2), disc string, trnval decimal(15,2), line_no long",
        [("OL001", None, 1, "A", "a", "", "", D(4), D(0), "", D(50), 0), ("SL009", None, 1, "A", "a", "", "", D(3), D(50), "", D(50), 1), ("SL001-A", None, 1, "A", "a", "", "", D(1), D(50), "", D(50), 2)],
    )
    customers = frame("cuscod string, cusnam string, paytrm int", [("31", "x", 0)])
    products, white = frame("stkcod string, unitpr decimal(15,2)", [("A", D(2))]), frame("stkcod string", [("B",)])

    def line(rule):
        out = jobs.ol_sl_ledger(docs, lines_, customers, products, white, [2024], [1], ["line_no"], credit_rule=rule)
        row = out["detail"].first()
        return row.unit_price, sorted(r.doc_number for r in out["credit"].collect())

    assert line("prefix") == (D("50.00"), ["SL001-A"])
    assert line("order") == (D("50.00"), ["SL009"])
