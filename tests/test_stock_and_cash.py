from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from ledgerloom.operators import cash, catalog, receivables, stock

MOVE = "docnum string, docdat date, stkcod string, trnqty decimal(15,2), line_no int, file_no int, source_file string"


def moves(frame, rows):
    return frame(MOVE, [(n, dt.date.fromisoformat(d) if d else None, s, D(q), i, f, f"f{f}") for i, (n, d, s, q, f) in enumerate(rows)])


def test_movement_summary(frame):
    rows = [("IV1", "2024-01-02", "s", 3, 0), ("IV2", "2023-12-30", "s", 2, 0), ("IV3", "2023-11-01", "s", 9, 0),
            ("RR1", "2020-01-01", "s", 7, 0), ("JU1", "2024-01-03", "s", -4, 0), ("TK1", "2024-01-04", "s", 5, 0), ("XX1", "2024-01-04", "s", 50, 0)]
    classed = stock.movement_classify(moves(frame, rows), dt.date(2024, 1, 10))
    got = stock.movement_summary(classed, frame("stkcod string", [("s",)])).first()
    assert (got.withdrawn_this_month, got.withdrawn_last_month, got.total_bought_in_qty) == (7, 2, 12)


def test_first_and_last_documents_keep_the_first_record(frame):
    rows = [("RR1", "2020-01-02", "s", 1, 1), ("HI1", "2020-01-02", "s", 1, 0), ("OL1", "2021-01-01", "s", 1, 0), ("IV1", "2021-01-01", "s", 1, 0), ("RR2", None, "s", 1, 0)]
    df = moves(frame, rows)
    skus = frame("stkcod string", [("s",), ("t",)])
    got = {r.stkcod: (r.docnum, r.source_file) for r in stock.earliest_receipt(df, skus).collect()}
    assert got == {"s": ("HI", "f0"), "t": (None, None)}
    assert stock.latest_issue(df).first().docnum_latest_export == "OL"


def test_product_stock_header_defaults(frame):
    products = frame("stkcod string, stkdes string", [("s", "x"), ("t", "y")])
    master = frame("stkcod string, totbal int, unitpr int, totval int, lpurdat date", [("t", 5, 2, 10, dt.date(2019, 1, 1))])
    df = moves(frame, [("RR1", "2020-01-02", "s", 4, 0)])
    got = {r.stkcod: r for r in stock.product_stock_header(products, master, df, dt.date(2024, 1, 10)).collect()}
    assert (got["s"].total_bought_in_qty, got["s"].cost, got["s"].docnum_earliest_import) == (4, 0, "RR")
    assert (got["t"].remaining_amount, got["t"].earliest_date_import, got["t"].total_bought_in_qty) == (5, dt.date(2019, 1, 1), 0)


def test_receivables_on_the_run_day(frame):
    d = dt.date
    docs = frame("docnum string, cuscod string, docdat date, duedat date, netval int, remamt int",
                 [("IV1", "c", d(2024, 6, 1), d(2024, 7, 1), 60, 10), ("IV2", "c", d(2023, 1, 1), d(2024, 7, 2), 9, 5), ("AI1", "c", d(2024, 6, 1), None, 7, 3)])
    got = receivables.customer_receivables(docs, dt.datetime(2024, 7, 1, 9)).first()
    assert (got.remaining_amt, got.remaining_morethan_duedat) == (15, 10)
    customers = frame("cuscod string, cusnam string, crline int, paytrm int", [("c", "n", 1, 2), ("e", "m", 1, 2)])
    avg = {r.cuscod: r.avg_sales for r in receivables.customer_avg_sales(docs, customers, d(2024, 7, 1)).collect()}
    assert avg == {"c": 10, "e": 0}
    bank = frame("chqnum string, cuscod string, payindat date, netamt int", [("QR1", "c", None, 8), ("QR2", "c", d(2024, 1, 1), 9), ("X", "c", None, 1)])
    row = receivables.customer_credit_profile(customers, docs, bank, dt.datetime(2024, 7, 1, 9)).where("customer_code = 'c'").first()
    assert (row.avg_sales, row.remaining_amt, row.remaining_morethan_duedat, row.chq_payindat_isnull, row.ai_notuse) == (10, 15, 10, 8, 3)


def test_cash_ledger(frame):
    d = dt.date
    bank = frame(
        "voucher string, chqnum string, trndat date, bnkacc string, payindat date, netamt decimal(15,2), chqdat date, remark string, cmplapp string, bktrntyp string, cuscod string",
        [("HI1", "*9", d(2025, 2, 1), "A", None, D(5), None, " r ", None, None, None), ("RE1", "8", d(2025, 2, 2), "  ", None, D(6), None, None, None, None, None),
         ("RE1", "7", d(2025, 2, 3), "B", None, D(7), None, "", None, None, None), (None, "BT1", d(2025, 2, 4), "C", None, D(8), d(2025, 3, 1), None, None, "BX", None),
         (None, "BT2", d(2025, 2, 4), "C", None, D(9), d(2025, 3, 1), None, None, "BT", None), (None, "BT3", d(2024, 2, 4), "C", None, D(9), None, None, None, "BT", None)],
    )
    ap = frame("docnum string, docdat date, supcod string", [("HI1", d(2025, 1, 2), "s1"), ("ZZ1", d(2025, 1, 2), "s2")])
    ar = frame("docnum string, docdat date, cuscod string", [("RE1", d(2025, 1, 3), "c1"), ("RE2", d(2024, 1, 3), "c2")])
    rows = cash.cash_ledger(ap, ar, bank, d(2025, 1, 1)).collect()
    got = {r.docnum: (r.type, r.chqnum, r.date, r.remark, r.cuscod or r.supcod) for r in rows}
    assert len(rows) == 4
    assert got["HI1"] == ("out", "9", d(2025, 2, 1), "r", "s1")
    assert got["RE1"] == ("in", "7", d(2025, 2, 3), None, "c1")
    assert got["BT1"][:3] == ("in", "BT1", d(2025, 3, 1)) and got["BT2"][:3] == ("out", "BT2", d(2025, 2, 4))


def test_fabric_load_keeps_category_and_turns_off(frame):
    ts = dt.datetime(2024, 1, 1)
    base = {c: None for c in catalog.FABRIC_COLUMNS}
    text = {"RefCode", "RefValue", "RefDescription", "UnitUOM", "WidthTxt", "WidthUOM", "composition", "Owner"}
    schema = ", ".join(f"{c} {'string' if c in text else 'int'}" for c in base)
    rows = [{**base, "RefCode": "ก A1", "FlagDelete": 0}, {**base, "RefCode": "B1", "FlagDelete": 1}, {**base, "RefCode": " "}]
    raw = frame(schema, [tuple(r.values()) for r in rows])
    known = ", ".join(f"{v} {'string' if k in text else 'int'}" for k, v in catalog.FABRIC_COLUMNS.items())
    existing = frame(known + ", product_category_id int, active int, created_at timestamp_ntz, updated_at timestamp_ntz",
                     [tuple("A1" if c == "ref_code" else None for c in catalog.FABRIC_COLUMNS.values()) + (3, 1, ts, ts)])
    match = frame("ref_code string, category_name string", [("B1", "blind")])
    categories = frame("id int, name string", [(5, "blind")])
    run = dt.datetime(2025, 1, 1)
    later = {r.ref_code: r for r in catalog.fabric_product_load(raw, existing, match, categories, run, False).collect()}
    assert (later["A1"].product_category_id, later["A1"].active, later["A1"].created_at) == (3, 0, ts)
    assert (later["B1"].product_category_id, later["B1"].active, later["B1"].price) == (8, 1, 0)
    first = {r.ref_code: r for r in catalog.fabric_product_load(raw, existing, match, categories, run, True).collect()}
    assert (first["A1"].product_category_id, first["B1"].product_category_id) == (8, 5)
