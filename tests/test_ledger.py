from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import filters, ledger, matching, refresh


def _loop(lines, credits):
    """Plain nested loop: (key, price, qty) lines in order against credit quantities."""
    left = [list(c) for c in credits]
    out = []
    for key, price, qty in lines:
        taken, matched = D(0), None
        for c in left:
            if taken >= qty:
                break
            if c[0] == key and key is not None and c[1] == price and price is not None and c[2] > 0:
                part = min(c[2], qty - taken)
                c[2] -= part
                taken += part
                matched = matched if matched is not None else c[1]
        out.append((taken, qty - taken, matched))
    return out


LINE = "k string, unitpr decimal(15,2), trnqty decimal(15,2), line_no int"


def _allocate(frame, lines, credits, blocks):
    df = frame(LINE, [(k, p, q, i) for i, (k, p, q) in enumerate(lines)])
    cr = frame(LINE, [(k, p, q, i) for i, (k, p, q) in enumerate(credits)])
    got = ledger.credit_allocation(df, cr, ["k"], "unitpr", ["line_no"], blocks=blocks).orderBy("line_no").collect()
    return [(r.qty_sc_sr_deducted, r.qty_balance, r.unit_price_from_sc_sr) for r in got]


def test_credit_allocation_fixture(frame):
    lines = [("k", D(10), D(5)), ("k", D(10), D(4)), ("k", D(10), D(-1))]
    credits = [("k", D(10), D(3)), ("k", D(10), D(4)), ("k", D(11), D(9))]
    assert _allocate(frame, lines, credits, 2) == [(5, 0, 10), (2, 2, 10), (0, -1, None)]


_ROW = st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([D(1), D(2), None]), st.integers(-2, 6).map(D))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_ROW, min_size=1, max_size=25), st.lists(_ROW, min_size=1, max_size=10), st.sampled_from([1, 3, 16]))
def test_credit_allocation_equals_the_loop(frame, lines, credits, blocks):
    assert _allocate(frame, lines, credits, blocks) == _loop(lines, credits)


def test_credit_allocation_of_one_hot_key(frame):
    rnd = random.Random(5)
    lines = [("hot", D(1), D(rnd.randrange(5))) for _ in range(400)]
    credits = [("hot", D(1), D(rnd.randrange(7))) for _ in range(100)]
    assert _allocate(frame, lines, credits, 16) == _loop(lines, credits)


def test_invoice_cost_status(frame):
    money = "decimal(15,2)"
    headers = frame("doc_number string", [("A",), ("B",), ("C",), ("D",)])
    lines = frame(
        f"doc_number string, stkcod string, cost {money}, qty_balance {money}",
        [("A", "s1", D(0), D(1)), ("B", "s1", D(5), D(0)), ("C", "s9", D(0), D(2))],
    )
    white = frame("stkcod string", [("s9",), (None,)])
    got = {r.doc_number: (r.status, r.cost_total) for r in ledger.invoice_cost_status(headers, lines, white).collect()}
    assert got == {"A": (0, 0), "B": (2, 0), "C": (1, 0), "D": (0, None)}


def test_bill_due_date(frame):
    d = dt.date
    headers = frame(
        "doc_number string, doc_date date, paytrm int, bilnum string, customer_code string, duedat date",
        [("IV1", d(2024, 1, 5), 30, "B1", "c1", None), ("IV2", d(2024, 1, 20), 15, "B1", "c2", None),
         ("IV3", d(2024, 1, 20), 15, "~", "c2", d(2024, 9, 9)), ("SR1", d(2024, 1, 1), 1, "B1", "c1", None)],
    )
    got = {r.doc_number: r.duedat for r in ledger.bill_due_date(headers).collect()}
    assert got == {"IV1": d(2024, 2, 19), "IV2": d(2024, 2, 19), "IV3": d(2024, 9, 9), "SR1": None}
    customers = frame("cuscod string, paytrm int", [("c1", 7)])
    got = {r.doc_number: r.duedat for r in ledger.bill_due_date(headers, customers, "customer").collect()}
    assert got["IV2"] == d(2024, 1, 27)


def _consolidate(frame, rows):
    df = frame("docnum string, seqnum string, line_no int, remark string", rows)
    return {r.docnum: (r.remark, r.so_number) for r in ledger.remark_consolidate(df).collect()}


def test_remark_consolidate_fixtures(frame):
    got = _consolidate(
        frame,
        [("A", "2", 1, "//2401018587"), ("A", "1", 2, "send //2) fast"), ("B", "1", 1, "a //2) b"), ("B", "2", 2, "//4) c //2)"),
         ("C", None, 1, None), ("D", "1", 1, "x ,y ,  ")],
    )
    assert got == {"A": ("send fast |", "SO2401018587"), "B": ("a b | c", "SO2,SO4"), "C": (None, None), "D": ("x, y, ", None)}


def _consolidate_loop(remarks):
    texts = [r for r in remarks if r]
    longs = [m for r in texts for m in re.findall(r"//\s*(\d{6,})(?=$|\s|\))", r)]
    shorts = list(dict.fromkeys(m for r in texts for m in re.findall(r"//\s*(\d+)\)", r)))
    so = f"SO{longs[0]}" if longs else ",".join(f"SO{s}" for s in shorts) or None
    out = re.sub(r"\s*,\s*", ", ", re.sub(r"\s{2,}", " ", re.sub(r"//\s*\d+\)?", "", " | ".join(texts)).strip()))
    return out or None, so


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["//1)", "// 22)", "//2401018587", "//7", " ", "  ", ",", "|", "ab", "\t", "ก", ""]), max_size=6).map("".join), min_size=1, max_size=5))
def test_remark_consolidate_equals_the_joined_text_rule(frame, remarks):
    rows = [("X", str(i), i, r) for i, r in enumerate(remarks)]
    assert _consolidate(frame, rows)["X"] == _consolidate_loop(remarks)


def test_credit_matching_by_suffix(frame):
    docs = "docnum string, docdat date, total decimal(15,2), line_no int"
    day = dt.date(2024, 1, 1)
    invoices = frame(docs, [("IV001", day, D(100), 1), ("IV009", day, D(5), 2)])
    credits = frame(docs, [("SR001", day, D(20), 3), ("SC001-1", day, D(5), 4), ("SR0012", day, D(9), 5)])
    got = {r.docnum: (r.net_total, r.debit_note_refs) for r in ledger.invoice_credit_netting(invoices, credits).collect()}
    assert got == {"IV001": (75, "SR001,SC001-1"), "IV009": (5, None)}
    assert ledger.credit_suffix_match(invoices, credits).count() == 2


def test_credit_prefix_semi_join(frame):
    invoices = frame("docnum string", [("OL001",)])
    credits = frame("docnum string", [("SL001",), ("SL001-A",), ("SL002",)])
    got = sorted(r.docnum for r in ledger.credit_prefix_semi_join(credits, invoices).collect())
    assert got == ["SL001", "SL001-A"]


def test_sale_area_longest_prefix(frame):
    docs = frame("customer_code string", [("2-15-016",), ("9",), (None,), ("",)])
    areas = frame("sale_area string, cuscod_startwith string", [("A", "2"), ("B", "2-15"), ("Z", "")])
    out = matching.sale_area_longest_prefix(docs, areas)
    assert {r.customer_code: r.sale_area_code for r in out.collect()} == {"2-15-016": "B", "9": None, None: None, "": None}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab-", max_size=6), min_size=1, max_size=12), st.sets(st.text("ab-", min_size=1, max_size=4), min_size=1, max_size=6))
def test_prefix_operators_equal_brute_force(frame, codes, prefixes):
    docs = frame("customer_code string, n int", [(c, i) for i, c in enumerate(codes)])
    areas = frame("sale_area string, cuscod_startwith string", [(f"<{p}>", p) for p in sorted(prefixes)])
    best = {i: max((p for p in prefixes if c.startswith(p)), key=len, default=None) for i, c in enumerate(codes)}
    got = {r.n: r.sale_area_code for r in matching.sale_area_longest_prefix(docs, areas).collect()}
    assert got == {i: (f"<{p}>" if p else None) for i, p in best.items()}
    kept = {r.n for r in matching.starts_with_any(docs, "customer_code", areas, "cuscod_startwith").collect()}
    assert kept == {i for i, p in best.items() if p}
    products = docs.withColumnRenamed("customer_code", "code")
    pairs = {(r.cuscod_startwith, r.n) for r in matching.contains_lookup(areas, "cuscod_startwith", products, "code").collect()}
    assert pairs == {(p, i) for p in prefixes for i, c in enumerate(codes) if p.lower() in c.lower()}


def test_prefix_plans_have_no_nested_loop(frame):
    docs = frame("customer_code string", [("2-15",)])
    areas = frame("sale_area string, cuscod_startwith string", [("A", "2")])
    for df in (
        matching.sale_area_longest_prefix(docs, areas),
        matching.starts_with_any(docs, "customer_code", areas, "cuscod_startwith"),
        matching.contains_lookup(areas, "cuscod_startwith", docs, "customer_code"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_line_row_order(frame):
    lines = frame("docnum string, stkcod string, seqnum int, line_no int", [("D", "S", 7, 1), ("D", "S", 3, 2), ("D", "T", 9, 3)])
    got = {(r.stkcod, r.seqnum): r.row_order for r in ledger.line_row_order(lines).collect()}
    assert got == {("S", 7): 2, ("S", 3): 1, ("T", 9): 1}


def test_code_map_with_missing(frame):
    codes = frame("code string", [("a",), ("c",), ("z",), (None,)])
    mapping = frame("old string, new string", [("a", "b"), ("c", "c"), ("z", None)])
    got = {(r.code, r.is_missing) for r in matching.code_map_with_missing(codes, "code", mapping, "old", "new").collect()}
    assert got == {("b", False), ("c", True), ("z", True), (None, False)}


def test_previous_months_are_pairs(frame):
    d = dt.date
    df = frame("d date", [(d(2023, 11, 1),), (d(2024, 11, 1),), (d(2024, 1, 31),), (d(2024, 2, 1),), (d(2023, 10, 31),)])
    got = sorted(r.d for r in filters.previous_months_filter(df, "d", d(2024, 2, 10), 3).collect())
    assert got == [d(2023, 11, 1), d(2024, 1, 31)]


def test_replace_date_range(frame):
    d = dt.date
    old = frame("d date, v string", [(d(2024, 1, 1), "o1"), (d(2024, 1, 5), "o5"), (d(2024, 1, 9), "o9")])
    new = frame("v string, d date", [("n5", d(2024, 1, 5))])
    run = lambda **kw: sorted(r.v for r in refresh.replace_date_range(old, new, "d", **kw).collect())
    assert run(start=d(2024, 1, 4), end=d(2024, 1, 6)) == ["n5", "o1", "o9"]
    assert run(purge="all") == ["n5"]
    assert run(purge="none") == ["n5", "o1", "o5", "o9"]
    with pytest.raises(ValueError):
        refresh.replace_date_range(old, new, "d")


def test_upsert_changes_only_the_named_columns(frame):
    old = frame("k string, a int, b int", [("x", 1, 1), ("y", 2, 2)])
    new = frame("k string, a int, b int", [("y", 9, None), ("z", 3, 3)])
    got = sorted(tuple(r) for r in refresh.upsert(old, new, "k", ["b"]).collect())
    assert got == [("x", 1, 1), ("y", 2, None), ("z", 3, 3)]


def test_insert_new_only_counts(frame):
    target, new = frame("k string", [("a",)]), frame("k string, v int", [("a", 1), ("b", 2)])
    fresh, counts = refresh.insert_new_only(target, new, "k")
    assert [tuple(r) for r in fresh.collect()] == [("b", 2)]
    assert tuple(counts.first()) == (2, 1, 1)


def test_customer_group_and_fallback_columns(frame):
    df = frame("c string, n string", [("3-1", "x"), ("2-1", "y")])
    got = [r[0] for r in df.select(ledger.customer_group_rule(F.col("c"), F.col("n"))).collect()]
    assert got == ["x", "อื่นๆ"]
