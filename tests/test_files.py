"""Scans and writers on files with tiny splits."""

from __future__ import annotations

import csv
import datetime as dt
import random
from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom import session, sinks
from ledgerloom.plans import staging
from ledgerloom.sources import dbf, decode, files, lines, records, tables

FIELDS = [("DOCNUM", "C", 8, 0), ("DOCDAT", "D", 8, 0), ("AMOUNT", "N", 10, 2), ("NAME", "C", 12, 0)]


def _write(path, records):
    body = b"".join(staging.dbf_record(r[:4], FIELDS, r[4]) for r in records)
    path.write_bytes(staging.dbf_header(FIELDS, len(records)) + body + b"\x1a")


def test_dbf_round_trip_over_splits_and_files(spark, tmp_path):
    first = [(f"IV{i:03d}", "20240101" if i % 2 else "2024xx01", f"{i}.25", "ไทย x", i % 10 == 0) for i in range(50)]
    second = [("OL001", "20230601", "oops", "", False)]
    _write(tmp_path / "b.dbf", first)
    _write(tmp_path / "a.DBF", second)
    paths = [str(tmp_path / "b.dbf"), str(tmp_path / "a.DBF")]
    df = dbf.dbf_multi_file_union(spark, paths, ["DOCNUM", "AMOUNT", "NAME", "DOCDAT", "ABSENT"], split_bytes=100)
    assert df.rdd.getNumPartitions() > 10
    rows = df.orderBy("file_no", "line_no").collect()
    assert len(rows) == 46
    assert rows[0].asDict() == {
        "source_file": "b.dbf", "file_no": 0, "line_no": 1, "docnum": "IV001", "amount": D("1.25"), "name": "ไทย x",
        "docdat": dt.date(2024, 1, 1), "absent": None,
    }
    assert rows[1].docdat is None and [r.line_no for r in rows[:3]] == [1, 2, 3]
    assert (rows[-1].docnum, rows[-1].amount, rows[-1].name, rows[-1].file_no) == ("OL001", None, "", 1)
    folder = dbf.dbf_scan(spark, str(tmp_path), ["DOCNUM"], date_field="DOCDAT", start=dt.date(2023, 1, 1), end=dt.date(2023, 12, 31))
    assert [r.docnum for r in folder.collect()] == ["OL001"]


def test_lines_are_read_once_whatever_the_split(spark, tmp_path):
    text = ["head", "skip,me"] + [f"{i}," + "ก" * (i % 5) for i in range(60)]
    (tmp_path / "r.csv").write_bytes("\r\n".join(text).encode("cp874"))
    offsets = None
    for split in (1, 7, 16, 1 << 20):
        df = lines.line_scan(spark, str(tmp_path / "r.csv"), skip=2, encoding="cp874", split_bytes=split)
        rows = df.orderBy("line_no").collect()
        assert [r.value for r in rows] == text[2:]
        offsets = offsets or [r.line_no for r in rows]
        assert [r.line_no for r in rows] == offsets


def test_report_cells(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes('x\n1,"a,b",3\n2\n\n4,,6\n7,8,9,10\n'.encode("cp874"))
    rows = lines.report_csv_scan(spark, str(tmp_path / "r.csv"), 1, 3).orderBy("line_no").collect()
    assert [(r.A, r.B, r.C) for r in rows] == [("1", "a,b", "3"), ("2", None, None), ("4", None, "6")]


def _odd_cells(seed, many):
    rng = random.Random(seed)
    pieces = ["a", "ก", '"', ",", "\n", "\r\n", " ", "x" * 40]
    return [["".join(rng.choice(pieces) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 4))] for _ in range(many)]


@pytest.mark.parametrize("encoding", ["cp874", "utf-8"])
def test_quoted_records_whatever_the_split(spark, tmp_path, encoding):
    """Cells with line feeds, commas and quotes across the borders of ranges, against a plain reader of whole files."""
    for number, end in enumerate(("\n", "\r\n")):
        with open(tmp_path / f"{number}.csv", "w", encoding=encoding, newline="") as out:
            csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL if number else csv.QUOTE_ALL).writerows([["two\nlines", "of head"], *_odd_cells(number, 150)])
    want = []
    for number in range(2):
        with open(tmp_path / f"{number}.csv", encoding=encoding, newline="") as source:
            # a line of blanks is no record, a quoted cell of blanks is one
            want += [(number, r) for r in list(csv.reader(source))[1:] if number == 0 or len(r) > 1 or not r[0] or r[0].strip(" ")]
    for split in (37, 256, 1000, 1 << 20):
        df = records.record_scan(spark, str(tmp_path), 1, encoding, split).orderBy("file_no", "line_no")
        assert [(r.file_no, r.cells) for r in df.collect()] == want, split


def test_states_of_quotes_are_those_of_a_loop():
    rng = random.Random(1)
    for _ in range(400):
        data = "".join(rng.choice('",\nab""') for _ in range(rng.randint(0, 200))).encode()
        quotes = records.Quotes(data)
        for state in range(5):
            now, ends = state, []
            for at, c in enumerate(data.decode()):
                if now == records.QUOTED:
                    now = records.CLOSED if c == '"' else now
                elif c == '"' and now != records.PLAIN:
                    now = records.QUOTED
                else:
                    now = {",": records.CELL, "\n": records.RECORD}.get(c, records.PLAIN)
                    ends += [at] if c in ",\n" else []
            assert quotes.after(state) == now and quotes.separators(state).tolist() == ends


def test_absent_values_quotes_inside_and_open_quotes(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes('NA,"NULL",nan\nx"y",5" pipe,"a"b"c\n \t \n"",,\n'.encode("cp874"))
    rows = lines.report_csv_scan(spark, str(tmp_path / "r.csv"), 0, 3).orderBy("line_no").collect()
    assert [(r.A, r.B, r.C) for r in rows] == [(None, None, None), ('x"y"', '5" pipe', 'ab"c'), (None, None, None)]
    (tmp_path / "open.csv").write_bytes(b'a,b\n1,"never closed\n2,3\n')
    for split in (6, 1 << 20):
        with pytest.raises(Exception, match="a quote is never closed"):
            lines.report_csv_scan(spark, str(tmp_path / "open.csv"), 0, 2, split_bytes=split).collect()


def test_a_record_longer_than_a_piece(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "CHUNK_BYTES", 64)
    cell = "line\n" * 200
    (tmp_path / "r.csv").write_text(f'h\n1,"{cell}"\n2,b', encoding="utf-8")
    rows = list(records.RecordReader({"path": str(tmp_path / "r.csv"), "skip": "1"}).read(records.RecordReader({"path": str(tmp_path / "r.csv")}).partitions()[0]))
    assert [c for b in rows for c in b.column("cells").to_pylist()] == [["1", cell], ["2", "b"]]


def test_small_ranges_cost_their_bytes(spark, tmp_path, monkeypatch):
    """Many small ranges: few tasks, and each range decodes its own records, not all that a piece holds."""
    want = [[str(i), f'a "quoted"\nword {i}', "x" * (i % 40)] for i in range(6000)]
    with open(tmp_path / "r.csv", "w", encoding="utf-8", newline="") as out:
        csv.writer(out, lineterminator="\r\n").writerows([["two\nlines", "of head"], *want])
    size, decoded, parse = (tmp_path / "r.csv").stat().st_size, [], records.records
    reader = records.RecordReader({"path": str(tmp_path / "r.csv"), "skip": "1", "split_bytes": "1000", "tasks": "4", "states": records.range_states(spark, files.byte_ranges(str(tmp_path / "r.csv"), (), 1000), 1000)})
    monkeypatch.setattr(records, "records", lambda data, encoding: (decoded.append(len(data)), parse(data, encoding))[1])
    parts = reader.partitions()
    rows = [c for p in parts for b in reader.read(p) for c in b.column("cells").to_pylist()]
    assert rows == want and len(parts) == 4
    assert len(decoded) > 200 and sum(decoded) <= 1.1 * size
    monkeypatch.undo()
    df = records.record_scan(spark, str(tmp_path), 1, "utf-8", 1000)
    assert df.rdd.getNumPartitions() <= 2 * session.shuffle_width(spark)
    assert [r.cells for r in df.orderBy("line_no").collect()] == want


def test_quoted_titles(spark, tmp_path):
    head = '"a\nb"\n' + "\n" * 4
    (tmp_path / "s.csv").write_text(head + '"name, long",SKU,"ราคาสินค้า/ชิ้น",จำนวน\n"n,\nm",00123,2.50,4.0\n', encoding="utf-8")
    row = lines.sheet_lines_scan(spark, {"no1": str(tmp_path / "s.csv")}, split_bytes=16).first()
    assert (row.store, row.sku, row.quantity, row.unit_price) == ("no1", "00123", 4, 2.5)


def test_sheets(spark, tmp_path):
    head = "\n" * 5
    (tmp_path / "s.csv").write_text(head + "name,SKU,ราคาสินค้า/ชิ้น,จำนวน\nn,00123,2.50,4.0\n", encoding="utf-8")
    row = lines.sheet_lines_scan(spark, {"no1": str(tmp_path / "s.csv")}).first()
    assert (row.store, row.sku, row.quantity, row.unit_price) == ("no1", "00123", 4, 2.5)


def test_links(spark, tmp_path):
    (tmp_path / "l.txt").write_text("http://a\n http://b \n\nhttp://a\n")
    assert sorted(r.url for r in lines.link_list_scan(spark, str(tmp_path / "l.txt")).collect()) == ["http://a", "http://b"]
    assert lines.link_list_scan(spark, str(tmp_path / "l.txt"), distinct=False).count() == 3


def test_feed(frame):
    raw = frame("json string", [('{"responseContent":[{"currency_id":"USD","period":"p","selling":"36.5"},{"currency_id":"EUR","period":"p","selling":"1"}]}',), ("broken",)])
    assert [tuple(r) for r in tables.rate_feed_scan(raw).collect()] == [("USD", "p", "36.5")]


def test_jdbc_options_cut_the_key_range():
    got = tables.jdbc_options("jdbc:x", "t", "id", 1, 1000, 8)
    assert (got["partitionColumn"], got["numPartitions"], got["upperBound"]) == ("id", "8", "1000")


def test_replaced_months_keep_the_rest_and_empty_months_go(spark, frame, tmp_path):
    d = dt.date
    path, staged = str(tmp_path / "t"), str(tmp_path / "s")
    rows = [("jan", d(2024, 1, 5)), ("jan2", d(2024, 1, 25)), ("feb", d(2024, 2, 5)), ("mar", d(2024, 3, 5)), ("dec", d(2023, 12, 1))]
    sinks.write_months(frame("v string, doc_date date", rows), path, "doc_date")
    new = frame("v string, doc_date date", [("new", d(2024, 1, 22))])
    sinks.replace_date_range_write(spark, path, new, "doc_date", d(2024, 1, 20), d(2024, 2, 29), staged)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["dec", "jan", "mar", "new"]


def test_report_export_is_clean_text(spark, frame, tmp_path):
    sinks.report_export({"raw": frame("a string, n int", [("x\x07\ty", 1)])}, str(tmp_path / "r"))
    row = spark.read.csv(str(tmp_path / "r" / "raw"), header=True).first()
    assert (row.a, row.n) == ("x\ty", "1")


def test_written_ledger_files(spark, frame):
    df = frame("docnum string, amount decimal(15,2), gone boolean", [("A1", D("1.50"), False), ("A2", D("-2.25"), True)])
    folder = staging.write_dbf(df, [("DOCNUM", "C", 6, 0), ("AMOUNT", "N", 9, 2)], F.lit("T"), F.col("gone"))
    assert [(r.docnum, r.amount) for r in dbf.dbf_scan(spark, folder).collect()] == [("A1", D("1.50"))]


def _table(frame, path):
    d = dt.date
    rows = [(f"{m}-{n}", d(2024, m, 5 + n), 1) for m in range(1, 7) for n in range(3)] + [("none", None, 1)]
    sinks.write_months(frame("doc_number string, doc_date date, amount int", rows), path, "doc_date")


def _rows(spark, path):
    return sorted((r.doc_number, str(r.doc_date), r.amount) for r in spark.read.parquet(path).collect())


def _stop_after_one_month(monkeypatch):
    """Let the next load put one month in place and then fail."""
    whole = sinks.write_months

    def broken(df, path, date_col):
        first = df.agg(F.min(F.month(date_col))).first()[0]
        whole(df.where(F.month(date_col) == first), path, date_col)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "write_months", broken)


@pytest.mark.parametrize("kind", ["range", "upsert"])
def test_a_load_that_fails_between_two_months_is_resumed(spark, frame, tmp_path, monkeypatch, kind):
    d, path, other = dt.date, str(tmp_path / "t"), str(tmp_path / "o")
    new = frame("doc_number string, doc_date date, amount int", [("2-1", d(2024, 2, 6), 9), ("x", d(2024, 5, 6), 9), ("none", None, 9)])

    def load(table):
        if kind == "range":
            sinks.replace_date_range_write(spark, table, new, "doc_date", d(2024, 2, 1), d(2024, 4, 30), f"{table}-staged")
        else:
            sinks.ledger_upsert_write(spark, table, new, "doc_date", f"{table}-staged", update_cols=["amount"])

    _table(frame, path)
    _table(frame, other)
    before = _rows(spark, path)
    load(other)
    with monkeypatch.context() as patch:
        _stop_after_one_month(patch)
        with pytest.raises(RuntimeError, match="lost"):
            load(path)
    assert sinks.unfinished(path) and _rows(spark, path) not in (before, _rows(spark, other))
    assert sinks.resume(spark, path) and not sinks.resume(spark, path)
    assert _rows(spark, path) == _rows(spark, other) != before and not sinks.unfinished(path)


def test_a_later_load_ends_a_broken_one_and_one_broken_early_leaves_no_trace(spark, frame, tmp_path, monkeypatch):
    d, path = dt.date, str(tmp_path / "t")
    _table(frame, path)
    before = _rows(spark, path)
    new = frame("doc_number string, doc_date date, amount int", [("2-1", d(2024, 2, 6), 9), ("5-1", d(2024, 5, 6), 9)])
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_note", lambda *_: (_ for _ in ()).throw(RuntimeError("early")))
        with pytest.raises(RuntimeError, match="early"):
            sinks.ledger_upsert_write(spark, path, new, "doc_date", str(tmp_path / "s"), update_cols=["amount"])
    assert _rows(spark, path) == before and not sinks.resume(spark, path)
    with monkeypatch.context() as patch:
        _stop_after_one_month(patch)
        with pytest.raises(RuntimeError, match="lost"):
            sinks.ledger_upsert_write(spark, path, new, "doc_date", str(tmp_path / "s"), update_cols=["amount"])
    late = frame("doc_number string, doc_date date, amount int", [("6-1", d(2024, 6, 6), 7)])
    sinks.ledger_upsert_write(spark, path, late, "doc_date", str(tmp_path / "s"), update_cols=["amount"])
    assert {r[0]: r[2] for r in _rows(spark, path) if r[2] > 1} == {"2-1": 9, "5-1": 9, "6-1": 7} and len(_rows(spark, path)) == len(before)


def test_an_upsert_leaves_other_months_alone(spark, frame, tmp_path):
    path = tmp_path / "t"
    _table(frame, str(path))
    files_before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    new = frame("doc_number string, doc_date date, amount int", [("2-1", dt.date(2024, 6, 1), 9), ("y", dt.date(2024, 4, 1), 9)])
    sinks.ledger_upsert_write(spark, str(path), new, "doc_date", str(tmp_path / "s"), update_cols=["amount"])
    kept = {p.parent.name for p, at in files_before.items() if p.exists() and p.stat().st_mtime_ns == at}
    assert kept == {"doc_month=202401", "doc_month=202403", "doc_month=202405", "doc_month=202406", "doc_month=__HIVE_DEFAULT_PARTITION__"}
    rows = {r[0]: r[1:] for r in _rows(spark, str(path))}
    assert rows["2-1"] == ("2024-02-06", 9) and rows["y"] == ("2024-04-01", 9) and len(rows) == 20
    sinks.ledger_upsert_write(spark, str(path), new.limit(0), "doc_date", str(tmp_path / "s"), update_cols=["amount"])
    assert len(_rows(spark, str(path))) == 20


def test_pages_lost_repeated_and_undeclared(spark, frame, tmp_path):
    def page(model, count, offset, read_no, ids, mark=""):
        records = ", ".join(f'{{"id": {i}, "name": "n{i}{mark}"}}' for i in ids)
        return f'{{"model": "{model}", "count": {count}, "offset": {offset}, "read_no": {read_no}, "records": [{records}]}}'

    text = [
        page("a", 12, 2, 0, [2, 3]), page("a", 12, 4, 1, [4, 5]), page("a", 12, 4, 5, [4, 5], "!"), page("a", 14, 8, 6, [8, 9, 5]), page("b", 1, 0, 0, [1, 2]), page("c", 0, 0, 0, []),
    ]
    (tmp_path / "p.json").write_text("\n".join(text))
    pages = tables.snapshot_pages(spark, str(tmp_path / "p.json"), "struct<id: long, name: string>")
    got = sorted(tuple(r) for r in tables.snapshot_findings(pages).collect())
    assert got == [("a", "missing", 0, 2), ("a", "missing", 6, 8), ("a", "missing", 11, 14), ("a", "repeated", 4, 6), ("b", "undeclared", 1, 2)]
    rows = sorted(tuple(r) for r in tables.snapshot_records(pages).where("model = 'a'").collect())
    assert rows == [("a", 2, "n2"), ("a", 3, "n3"), ("a", 4, "n4!"), ("a", 5, "n5"), ("a", 8, "n8"), ("a", 9, "n9")]


def test_layouts_of_many_files_are_read_by_tasks(spark, tmp_path):
    for i in range(12):
        fields = [("DOC", "C", 4, 0), ("AMT", "N", 6 + i, i % 3), *([("LATE", "C", 3, 0)] if i > 6 else [])]
        (tmp_path / f"{i:02d}.dbf").write_bytes(staging.dbf_header(fields, 1) + staging.dbf_record([f"A{i}", str(i), "x"][: len(fields)], fields, False) + b"\x1a")
    found = dbf.merged_fields(dbf.all_fields(spark, str(tmp_path)))
    assert [(f.name, f.kind, f.width, f.decimals) for f in found.values()] == [("DOC", "C", 4, 0), ("AMT", "N", 17, 2), ("LATE", "C", 3, 0)]
    rows = dbf.dbf_scan(spark, str(tmp_path)).orderBy("doc").collect()
    assert len(rows) == 12 and {r.amt for r in rows} == {D(i) for i in range(12)}


def test_thai_cells_without_a_loop(spark, tmp_path):
    fields = [("NAME", "C", 12, 0), ("NOTE", "C", 3, 0)]
    names = ["ไทย", "น้ำ ดี", "", "plain", "ก" * 12, "  ใจ"]
    body = b"".join(staging.dbf_record([n, "ข"], fields, False) for n in names) + b" " + b"\xfe\xff\xa1         " + b"\x80\xdb "
    (tmp_path / "a.dbf").write_bytes(staging.dbf_header(fields, len(names) + 1) + body + b"\x1a")
    got = [(r.name, r.note) for r in dbf.dbf_scan(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert got == [(n.rstrip(), "ข") for n in names] + [(bytes([0xFE, 0xFF, 0xA1]).decode("cp874", "replace"), bytes([0x80, 0xDB]).decode("cp874", "replace"))]


def test_text_of_any_encoding():
    for encoding, words in (("cp874", ["ไทย", "", "a"]), ("utf-8", ["ไทย", "é", ""]), ("gbk", ["中文", "", "b"]), ("latin-1", ["é", "ÿ"]), ("ascii", ["a", "b"])):
        data = [w.encode(encoding) for w in words]
        cuts = np.cumsum([0, *map(len, data)])
        assert decode.texts(b"".join(data), cuts, encoding).to_pylist() == words
    assert decode.texts(b"a\xffb", np.array([0, 1, 3]), "utf-8").to_pylist() == ["a", "\ufffdb"]


def test_written_ledger_files_are_bounded(spark, frame, monkeypatch):
    monkeypatch.setattr(staging, "FILE_BYTES", 40)
    df = frame("docnum string, year string", [(f"A{i}", f"T{i % 2}") for i in range(30)]).coalesce(1)
    folder = staging.write_dbf(df.withColumn("gone", F.lit(False)), [("DOCNUM", "C", 6, 0)], F.col("year"), F.col("gone"))
    rows = dbf.dbf_scan(spark, folder).collect()
    assert sorted(r.docnum for r in rows) == sorted(f"A{i}" for i in range(30))
    files_ = {r.source_file for r in rows}
    assert len(files_) >= 4 and all(int(r.docnum[1:]) % 2 == int(r.source_file[1]) for r in rows)


def test_order_rejects_give_every_reason(frame):
    from ledgerloom.operators import orders

    asked = frame(
        "order_no long, customer_code string, type_id string, order_date string, delivery_date string, note string, product array<struct<product_id: string, width: double, height: double, qty: int>>",
        [(1, "c", "t", "01/01/2024 05:00:00", "01/01/2024", "", [("p", 1.0, 1.0, 2), ("q", 1.0, 1.0, 1)]), (2, "x", "y", None, None, "", []), (3, "x", "no house", None, None, "", []), (4, None, "t", None, None, "", None)],
    )
    partners, types = frame("ref string, id long", [("c", 1)]), frame("name string, id long, warehouse_id long", [("t", 1, 5), ("no house", 2, 6)])
    headers, lines_, rejects = orders.order_staging(asked, partners, types, frame("id long", [(5,)]), frame("id string", [("p",)]))
    assert [r.order_no for r in headers.collect()] == [1] and [(r.line_no, r.product_id) for r in lines_.collect()] == [(1, "p")]
    want = [(1, 2, "unknown product", "q"), (2, None, "unknown customer", "x"), (2, None, "unknown order type", "y"), (3, None, "unknown customer", "x"), (3, None, "unknown warehouse", "no house"), (4, None, "unknown customer", None)]
    assert sorted(map(tuple, rejects.collect()), key=str) == sorted(want, key=str)
