from __future__ import annotations

import datetime as dt
import random
import unicodedata
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, numbers, text
from ledgerloom.operators import calendar, catalog, filters, matching, pages
from ledgerloom.schemas import conform, struct


def one(frame, value, fn, schema="c string"):
    return frame(schema, [(value,)]).select(fn(F.col("c"))).first()[0]


def test_blank_to_null_trims_unicode_space(frame):
    for value in ("  ", "~", "None", " nan\t", " ", None):
        assert one(frame, value, text.blank_to_null) is None
    assert one(frame, " x y\t", text.blank_to_null) == "x y"


def test_bad_numbers_and_dates_do_not_raise(frame):
    assert one(frame, "abc", numbers.numeric_or_zero) == 0
    assert one(frame, "12.345", numbers.numeric_or_zero) == D("12.35")
    assert one(frame, "20241301", dates.date_or_null) is None
    assert one(frame, "20240528", dates.date_or_null) == dt.date(2024, 5, 28)


def test_text_match_key(frame):
    key = one(frame, " Ａ　 b\tc ", lambda c: text.text_match_key(F.lit("0001"), F.lit("S"), c))
    assert key == "0001|S|A b c"
    assert one(frame, None, lambda c: text.text_match_key(F.lit("0001"), F.lit("S"), c)) == "0001|S|"
    assert one(frame, None, lambda c: text.text_match_key(F.lit("0001"), c, F.lit("x"))) is None


def test_codes(frame):
    assert one(frame, "[A-1] name [B]", text.bracket_code) == "A-1"
    assert one(frame, "none", text.bracket_code) is None
    assert one(frame, "กขAB", text.leading_thai_strip) == "ขAB"
    assert one(frame, "ผ้า Black out ROMA 4A สีขาว", text.fabric_code) == "ROMA 4A "
    assert one(frame, "ROMA 4A ผ้า", text.fabric_code_upper).strip() == "ROMA 4A"
    assert one(frame, "ม่านพลาสติก X", text.fabric_code_upper) == ""
    assert one(frame, "a/b:c d.txt", text.safe_file_name) == "a_b_c d.txt"
    assert one(frame, "*123", text.cheque_number_clean) == "123"
    assert one(frame, "12*3", text.cheque_number_clean) == "12*3"


def test_honorific_longest_first(frame):
    df = frame("c string", [("บมจ.ธนาคาร ก",), ("Dr. Who",), ("Somchai",), ("คุณหมอเอ",)])
    title, rest = text.honorific_split(F.col("c"))
    got = [tuple(r) for r in df.select(title, rest).collect()]
    assert got == [("บมจ.ธนาคาร", "ก"), ("Dr.", "Who"), ("", "Somchai"), ("คุณหมอ", "เอ")]


def test_control_characters(frame):
    value = "a\x00b\tc\nd\re\x85f"
    assert one(frame, value, text.control_char_strip) == "abcdef"
    assert one(frame, value, lambda c: text.control_char_strip(c, keep_tab_newline=True)) == "ab\tc\nde\x85f"


def test_thai_dates(frame):
    assert one(frame, "28 พ.ค. 2567", dates.thai_date_to_iso) == dt.date(2024, 5, 28)
    assert one(frame, "31 ก.พ. 2567", dates.thai_date_to_iso) is None
    assert one(frame, "x", dates.thai_date_to_iso) is None


def test_local_to_utc(frame):
    assert one(frame, "26/06/2024 05:00:00", dates.local_to_utc) == dt.datetime(2024, 6, 25, 22)
    assert one(frame, "26/06/2024", dates.delivery_date) == dt.date(2024, 6, 26)


def test_run_date_ranges():
    assert dates.trailing_months_range(dt.date(2025, 5, 31), 3) == (dt.date(2025, 2, 1), dt.date(2025, 5, 31))
    assert dates.previous_n_calendar_months(dt.date(2024, 2, 1), 3) == [(2024, 1), (2023, 12), (2023, 11)]
    assert dates.months_before(dt.date(2024, 8, 31), 6) == dt.date(2024, 2, 29)


def test_area_price(frame):
    cols = numbers.area_price(F.lit(0.5), F.lit(0.5), F.lit(596.0))
    row = frame("x int", [(1,)]).select(*[c.alias(n) for n, c in cols.items()]).first()
    assert (row.area, round(row.quantity, 6), round(row.addon, 6), row.value) == (0.25, 0.3, 536.4, 596.0)
    big = numbers.area_price(F.lit(2.0), F.lit(1.0), F.lit(5.0))["addon"]
    assert frame("x int", [(1,)]).select(big).first()[0] is None


def test_bank_and_payment_labels(frame):
    df = frame("c string", [("BT",), ("BX",), (None,), ("QQ",)])
    assert [r[0] for r in df.select(numbers.bank_flow_type(F.col("c"))).collect()] == ["out", "in", None, None]
    assert one(frame, "partial", lambda c: numbers.payment_state_label(F.lit("posted"), c)) == "Partially Paid"
    assert one(frame, "paid", lambda c: numbers.payment_state_label(F.lit("draft"), c)) == "Draft."


def test_round_half_even(frame):
    df = frame("c decimal(10,3)", [(D("0.125"),), (D("0.135"),)])
    assert [r[0] for r in df.select(numbers.round_half_even(F.col("c"))).collect()] == [D("0.12"), D("0.14")]


def test_conform(frame):
    out = conform(frame("B int, a string", [(1, "2")]), struct("a int, b string, c money"))
    assert [f.simpleString() for f in out.schema.fields] == ["a:int", "b:string", "c:decimal(15,2)"]
    assert tuple(out.first()) == (2, "1", None)


def test_many2one_and_lists(frame):
    df = frame("c string", [('[12, "A \\"x\\", B"]',), ("false",), (None,)])
    number, name = catalog.many2one_decode(F.col("c"))
    assert [tuple(r) for r in df.select(number, name).collect()] == [(12, 'A "x", B'), (None, None), (None, None)]


def test_duplicate_list_ids(frame):
    products = frame("product_id bigint, attribute_line array<bigint>", [(1, [1, 2, 1]), (2, [3, 4])])
    assert [tuple(r) for r in catalog.duplicate_list_ids(products).collect()] == [(1, 1, 2)]
    lines = frame("attribute_line_id bigint, v string", [(1, "a"), (3, "c"), (4, "d")])
    assert sorted(r.v for r in catalog.attribute_line_explode(products, lines).collect()) == ["c", "d"]


def test_price_surface(frame):
    heights, widths = [0.5 + 0.1 * i for i in range(26)], [0.5 + 0.1 * i for i in range(33)]
    surface = frame("height string, width string, price int", [(f"{h:.2f}", f"{w:.2f}", i * 100 + j) for i, h in enumerate(heights) for j, w in enumerate(widths)])
    probes = frame("width double, height double", [(2.0, 2.0), (9.0, 9.0), (0.1, 0.1), (0.55, 1.0)])
    out = matching.price_surface_lookup(probes, surface, heights, widths)
    got = {(r.width, r.height): int(r.price) for r in out.collect()}
    assert got == {(2.0, 2.0): 1515, (9.0, 9.0): 2532, (0.1, 0.1): 0, (0.55, 1.0): 501}


def test_priority_last_duplicate_wins(frame):
    products = frame("id int, priority int", [(1, 0), (2, 0)])
    updates = frame("name string, p string, n int", [(" 1", "5", 1), ("1 ", "7", 2), ("9", "1", 3)])
    got = matching.priority_map_update(products, updates, "id", "name", "p", "n").collect()
    assert sorted((r.id, r.priority) for r in got) == [(1, 7), (2, 0)]


def test_domain_terms(frame):
    df = frame("id int, name string", [(1, "Advance x"), (2, None), (3, "other")])
    ids = lambda c: sorted(r.id for r in filters.domain_filter(df, c).collect())
    assert ids(("name", "ilike", "aDV")) == [1]
    assert ids(("name", "!=", "other")) == [1, 2]
    assert ids(("name", "set", False)) == [2]
    assert ids(filters.any_of(("id", "=", 3), ("name", "=", None))) == [2, 3]


def test_month_ranges(frame):
    seq = frame("id int, name string", [(1, "Advance A"), (2, "x")])
    got = calendar.sequence_month_ranges(seq, dt.date(2024, 1, 15), dt.date(2024, 3, 1)).orderBy("date_from").collect()
    assert [(r.date_from.month, r.date_to.day) for r in got] == [(1, 31), (2, 29), (3, 31)]


def test_page_cards(frame):
    html = (
        "<!-- <div x-data='ProductCard'><a class='product-name' href='/no'></a></div> -->"
        '<div class="c" x-data="ProductCard"><a href="/skip">s</a><a href="/p/1?a=1&amp;b=2" class="big product-name">x</a></div>'
        "<DIV x-data='ProductCard'><p>none</p></DIV>"
        "<div x-data='ProductCard'><a class='product-name' href='/p/2'>y</a></div><div x-data='Other'><a class='product-name' href='/p/3'></a></div>"
    )
    rows = pages.page_product_links(frame("page_id int, html string", [(1, html)]), "https://h/").collect()
    assert sorted((r.position, r.link) for r in rows)[0] == (0, "https://h//p/1?a=1&b=2")
    assert "https://h//p/2" in {r.link for r in rows} and not any("no" in r.link for r in rows)
    cards = (
        '<div class="card col-md-3 border-0"><img class="card-img-top" src="/a.png"></div><a class="card-title fw-bold"><p> A <b>1</b> </p></a>'
        '<div class="card col-md-3 border-0"><img src="https://x/b.png" class="card-img-top"></div><a class="card-title fw-bold">no text</a>'
    )
    got = pages.page_image_cards(frame("page_id int, html string", [(1, cards)]), "https://h").orderBy("position").collect()
    assert [(r.image_link, r.description) for r in got] == [("https://h/a.png", "A 1"), ("https://x/b.png", None)]


def _product_links(frame, html):
    rows = pages.page_product_links(frame("page_id int, html string", [(1, html)]), "h").collect()
    return sorted((r.position, r.link) for r in rows)


def test_a_search_stays_inside_its_card(frame):
    card, anchor = "<div x-data='ProductCard'>", "<a class='product-name' href='/{}'></a>"
    outside = anchor.format("outside")
    # no link, then an anchor outside of any card
    assert _product_links(frame, f"{card}<p>none</p></div>{outside}{card}{anchor.format(2)}</div>") == [(1, "h/2")]
    # nested cards: the outer card's first anchor may be the inner one's
    assert _product_links(frame, f"{card}{card}{anchor.format('in')}</div>{anchor.format('out')}</div>{outside}") == [(0, "h/in"), (1, "h/in")]
    assert _product_links(frame, f"{card}<div>{card}</div></div>{anchor.format('out')}</div>") == [(0, "h/out")]
    # void, self-closing and unclosed tags, end tags of nothing; the section's end closes the card inside it
    assert _product_links(frame, f"<section>{card}<br><img><p><i></section>{outside}</div>") == []
    assert _product_links(frame, f"{card}<hr><b/></span></p>{anchor.format(1)}") == [(0, "h/1")]
    assert _product_links(frame, f"{card[:-1]}/>{outside}") == []
    # comments, scripts, quoted signs and upper case
    assert _product_links(frame, f"<DIV X-DATA=\"ProductCard\" title='</div>'><!-- </div> --><script>'</div>'</script>{anchor.format(1)}</Div>{outside}") == [(0, "h/1")]
    assert _product_links(frame, "<div x-data=ProductCard><a href=/1?a=1&amp;b=2 class='big product-name'></div>") == [(0, "h/1?a=1&b=2")]
    assert _product_links(frame, "<div x-data='ProductCards'><a class='product-names' href='/1'>") == []
    assert _product_links(frame, None) == _product_links(frame, "") == _product_links(frame, "<div <<>a</") == []


def test_cards_without_image_or_text(frame):
    html = (
        "<div class='card  col-md-3 border-0'><p>no image</p></div><img class='card-img-top' src='/outside'>"
        "<div class='card col-md-3 border-0'><div><img class='x card-img-top' src='/in.png'></div></div><a class='card-title fw-bold'></a><p>outside</p>"
        "<a class='card-title fw-bold'><p> caf&eacute;&#33; <!-- no --><b>bold</b></a>"
    )
    got = pages.page_image_cards(frame("page_id int, html string", [(1, html)]), "h").orderBy("position").collect()
    assert [(r.image_link, r.description) for r in got] == [(None, "caf&eacute;! bold"), ("h/in.png", None)]


def test_long_unclosed_attributes_take_no_time(frame):
    assert _product_links(frame, "<div " + 'a="b" ' * 20_000) == [] == _product_links(frame, "<div x='" + "=\"'" * 20_000)


def test_contained_text_is_that_of_all_pairs(frame):
    rng = random.Random(4)
    codes = ["".join(rng.choice("abAB1-ก") for _ in range(rng.randint(0, 12))) for _ in range(150)] + ["x" * 3000 + "needle", None]
    needles = ["".join(rng.choice("abAB1-ก") for _ in range(rng.randint(1, 5))) for _ in range(60)] + ["needle", "xx", " ", "zzz", "x" * 2000, None]
    left = frame("needle string", [(n,) for n in needles])
    right = frame("id int, code string", list(enumerate(codes)))
    got = {(r.needle, r.id) for r in matching.contains_lookup(left, "needle", right, "code").collect()}
    assert got == {(n.strip(), i) for n in needles if n and n.strip() for i, c in enumerate(codes) if c and n.strip().lower() in c.lower()}


def test_price_requests_are_not_shuffled(frame):
    surface = frame("height string, width string, price int", [("1.00", "1.00", 5), ("1.00", "2.00", 7), ("2.00", "2.00", None), ("9.00", "1.00", 4)])
    probes = frame("id int, width double, height double", [(1, 0.5, 0.5), (2, 1.5, None), (3, None, 1.0), (4, 2.0, 1.5)])
    out = matching.price_surface_lookup(probes, surface, [2.0, 1.0], [1.0, 2.0])
    rows = sorted((r.id, float(r.grid_height), float(r.grid_width), r.price and int(r.price)) for r in out.collect())
    assert rows == [(1, 1.0, 1.0, 5), (2, 2.0, 2.0, None), (3, 1.0, 2.0, 7), (4, 2.0, 2.0, None)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in plan and "Join" not in plan


def test_compatibility_form_of_all_characters(spark):
    codes = spark.range(32, 0x11000).where("id NOT BETWEEN 55296 AND 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    both = codes.select(char.alias("c")).select("c", text.nfkc(F.col("c")).alias("one"), text.nfkc(F.concat(F.lit("aก"), "c", F.lit("́า"))).alias("two"))
    assert "Python" not in both._jdf.queryExecution().executedPlan().toString()
    known = [r for r in both.collect() if len(r.c) == 1 and unicodedata.category(r.c) != "Cn"]
    assert len(known) > 50_000 and all(unicodedata.normalize("NFKC", r.c) == r.one for r in known)
    assert all(unicodedata.normalize("NFKC", f"aก{r.c}́า") == r.two for r in known)
    assert text.nfkc(F.lit("นำ")) is not None
    odd = spark.createDataFrame([("น้ำ ำ ﬁ Å ２", 1), (None, 2), ("", 3)], "c string, i int").select("i", text.nfkc(F.col("c")).alias("n")).orderBy("i").collect()
    assert [r.n for r in odd] == [unicodedata.normalize("NFKC", "น้ำ ำ ﬁ Å ２"), None, ""]


def test_prefix_forms_are_those_built_by_hand(frame):
    df = frame("id int, name string, size int", [(i, None if i % 7 == 0 else f"{'Goods' if i % 2 else 'Raw'} / {i}", i % 5) for i in range(60)])
    ids = lambda c: sorted(r.id for r in filters.domain_filter(df, c).collect())
    goods, raw, small, late = ["name", "ilike", "goods /"], ["name", "ilike", "raw /"], ["size", "<", 2], ["id", ">=", 30]
    t = lambda x: filters.term(tuple(x))
    assert ids(["|", goods, raw]) == ids(t(goods) | t(raw))
    assert ids([goods, small]) == ids(["&", goods, small]) == ids(t(goods) & t(small))
    assert ids(["|", goods, "&", raw, small, late]) == ids((t(goods) | (t(raw) & t(small))) & t(late))
    assert ids(["|", "|", goods, small, late]) == ids(t(goods) | t(small) | t(late))
    assert ids(["!", "|", goods, raw]) == [i for i in range(60) if i % 7 == 0]
    assert ids([]) == list(range(60)) and ids([["name", "not in", ["Raw / 2"]]]) == [i for i in range(60) if i != 2]
    for broken in (["|", goods], ["&"], ["?", goods, raw]):
        with pytest.raises(ValueError):
            filters.domain(broken)
