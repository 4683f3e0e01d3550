from __future__ import annotations

import random

from ledgerloom.operators import reports

LETTERS = "ABCDEFGHIJKLMNOPQR"


def cells(frame, rows, letters=LETTERS):
    schema = "source_file string, line_no int, " + ", ".join(f"{c} string" for c in letters)
    return frame(schema, [(r.get("file", "f"), i, *[r.get(c) for c in letters]) for i, r in enumerate(rows)])


def test_customer_invoices(frame):
    rows = [
        {"D": "old", "F": "h1", "H": "x"},
        {"F": "h2", "H": "x", "K": "1"},
        {"D": "Ann", "E": "c1", "F": "2024", "H": "s", "I": "t", "J": "10.00", "K": "0.00", "L": "10.00"},
        {"L": " --------------- "},
        {"F": "2025", "H": "s", "I": "t", "J": "7.00", "K": "3.00", "L": "4.00"},
        {"F": "2025", "I": "R1", "L": "1"},
        {"K": " ใบ ", "L": "2"},
        {"D": "=====", "F": "x"},
        {"D": "Bob", "E": "c2", "G": "only G"},
        {"D": "Bob", "E": "c3", "J": "1", "K": "2"},
    ]
    mapping = frame("o string, n string", [("c1", "C-1"), ("c3", "c3")])
    out = reports.normalize_report(cells(frame, rows), reports.REPORTS["1a2"], mapping, block_size=2).orderBy("line_no").collect()
    got = [(r["Partner"], r["Partner Code"], r["Total"], r["Note"], r["Blank"], r["IsMissing"]) for r in out]
    assert got == [
        ("Ann", "C-1", "10.00", "", "", False),
        ("Ann", "C-1", "4.00", "Invoice = 7.00 รับชำระแล้ว = 3.00", "", False),
    ]


def test_received_cheques_memo(frame):
    rows = [{"E": "head"}, {"C": "t", "D": "u", "E": "1", "J": "c1", "L": "5", "O": "note", "P": "p"}, {"E": "2", "O": "alone"}, {"E": "3"}]
    out = reports.normalize_report(cells(frame, rows), reports.REPORTS["3c"], frame("o string, n string", [])).orderBy("line_no").collect()
    assert [(r["text_1"], r["Memo"], r["Payment Type"]) for r in out] == [
        ("t", "note_p", "Recive Money"), ("t", "alone", "Recive Money"), ("t", "nan", "Recive Money"),
    ]


def test_files_are_filled_and_cut_separately(frame):
    rows = [{"file": f, "C": f"{f}{i}", "E": "1"} for f in "xy" for i in range(3)]
    out = reports.normalize_report(cells(frame, rows), reports.REPORTS["tb"]).collect()
    assert sorted(r["Account Name"] for r in out) == ["x1", "x2", "y1", "y2"]


def _attach_loop(rows, mark="หมายเหตุ"):
    """The row-by-row rule."""
    val = lambda r, c: (r.get(c) or "").strip()
    notes, gone, i = {}, set(), 0
    while i < len(rows):
        if i > 0 and mark in (rows[i].get("D") or ""):
            j, lines = i + 1, []
            while j < len(rows) and not val(rows[j], "B") and not val(rows[j], "C") and val(rows[j], "D"):
                lines.append(val(rows[j], "D"))
                gone.add(j)
                j += 1
            notes[i - 1] = f"{mark}:\n" + "\n".join(lines)
            gone.add(i)
            i = j
        else:
            i += 1
    return [(k, notes.get(k)) for k in range(len(rows)) if k not in gone]


def test_note_attach_equals_the_row_loop(frame):
    rnd = random.Random(11)
    for size in (1, 3, 50):
        rows = []
        for _ in range(150):
            kind = rnd.random()
            if kind < 0.2:
                rows.append({"D": " หมายเหตุ "})
            elif kind < 0.5:
                rows.append({"D": rnd.choice([" text ", "หมายเหตุ again", "more"])})
            elif kind < 0.6:
                rows.append({"B": "b", "D": "หมายเหตุ"})
            else:
                rows.append({"B": rnd.choice(["b", None, " "]), "C": rnd.choice(["c", None]), "D": rnd.choice([None, "d"])})
        df = cells(frame, rows, "BCD")
        got = [(r.line_no, r.U) for r in reports.note_attach(df, block_size=size).orderBy("line_no").collect()]
        assert got == _attach_loop(rows)


def test_asset_sections(frame):
    rows = [
        {"B": "before", "F": "1"},
        {"B": "117-01", "C": "Cars", "L": "dep"},
        {"B": "a1", "C": "car", "F": "1", "R": "9"},
        {"D": "หมายเหตุ"},
        {"D": "sold"},
        {"B": " รวม ", "F": "1"},
        {"B": "123-02", "C": "Desks", "L": "dep2"},
        {"B": "a2", "C": "desk", "G": "1"},
    ]
    out = reports.asset_report(cells(frame, rows), block_size=2).orderBy("line_no").collect()
    got = [(r["Asset Account"], r["Asset Profile Name"], r["Depr.Expense Account"], r["Asset Code"], r["Salvage Value"], r["Note"]) for r in out]
    assert got == [("117-01", "Cars", "dep", "a1", "9", "หมายเหตุ:\nsold"), ("123-02", "Desks", "dep2", "a2", None, None)]
