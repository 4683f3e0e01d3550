"""Product cards in stored HTML pages.

The borders of elements follow from the stack of open tags, which no built-in expression keeps: a small function walks the tag stream of a page and
gives the elements of the names asked for with their borders. What lies in which card is then decided by these borders in Spark expressions, so a search
stays inside its card, whatever is nested, void or never closed. Attributes may come in any order and either quote.
"""

from __future__ import annotations

import html as html_text
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import text

_INERT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"

# fixed values: marks of the pages read
CARD_MARK = ("x-data", "ProductCard")
LINK_CLASS = "product-name"
IMAGE_CARD_CLASSES = "card col-md-3 border-0"
IMAGE_CLASS = "card-img-top"
TITLE_CLASSES = "card-title fw-bold"


# fixed values: elements that never hold others
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta nextid param source spacer track wbr".split()
)

_TOKEN = re.compile(
    r"""(?s)<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\s*=\s*"[^"]*"|\s*=\s*'[^']*'|[^>])*+)>"""
)
_PAIR = re.compile(r"""(?s)([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_ELEMENT = "struct<name: string, attributes: map<string, string>, at: int, begin: int, stop: int>"


def _attributes(rest: str) -> list[tuple[str, str]]:
    found = {name.lower(): html_text.unescape(value[1:-1] if value[:1] in ("'", '"') else value) for name, value in _PAIR.findall(rest)}
    return list(found.items())


def tag_stream(page: str) -> Iterator[tuple[str, bool, str, int, int]]:
    """(name, closes, attribute text, place, place behind it) of every tag; comments, declarations and what scripts and styles hold are passed over."""
    at = 0
    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            return
        at = token.end()
        if token["name"] is None:
            continue
        name = token["name"].lower()
        yield name, bool(token["end"]), token["rest"], token.start(), at
        if name in ("script", "style") and not token["end"]:
            closing = re.compile(rf"(?i)</{name}\s*>").search(page, at)
            at = closing.start() if closing else len(page)


def page_elements(page: str, names: frozenset[str]) -> list[tuple]:
    """(name, attributes, place, where its content begins and stops) of the elements with one of the names, in document order.

    The open elements are a stack. An end tag closes the innermost open element of its name and all inside it; one that
    matches none is passed over; void and self-closing elements hold nothing; what is still open ends with the page.
    """
    found: list[list] = []
    stack: list[tuple[str, list | None]] = []
    open_: Counter[str] = Counter()

    def close(place: int) -> str:
        name, element = stack.pop()
        open_[name] -= 1
        if element is not None:
            element[4] = place
        return name

    for name, closes, rest, place, behind in tag_stream(page):
        if closes:
            while open_[name] and close(place) != name:
                pass
            continue
        element = None
        if name in names:
            element = [name, _attributes(rest), place, behind, behind]
            found.append(element)
        if name not in VOID and not rest.rstrip().endswith("/"):
            stack.append((name, element))
            open_[name] += 1
    while stack:
        close(len(page))
    return [tuple(e) for e in found]


def elements(html: Column, names: Iterable[str]) -> Column:
    """array of (name, attributes, at, begin, stop) of the elements with one of the names; places are characters from 0."""
    wanted = frozenset(names)

    @F.arrow_udf(f"array<{_ELEMENT}>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fields = [("name", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("at", pa.int32()), ("begin", pa.int32()), ("stop", pa.int32())]
        kind = pa.list_(pa.struct(fields))
        names = [n for n, _ in fields]
        for batch in batches:
            rows = [None if page is None else [dict(zip(names, e, strict=True)) for e in page_elements(page, wanted)] for page in batch.to_pylist()]
            yield pa.array(rows, kind)

    return found(html)


def _attribute(element: Column, name: str) -> Column:
    return F.try_element_at(element["attributes"], F.lit(name))


def _named(found: Column, name: str, attribute: str, value: str, word: bool = False) -> Column:
    """The elements of a name whose attribute is the value (of a class: the same words), or holds it as a word."""

    def fits(e: Column) -> Column:
        words = F.filter(F.split(_attribute(e, attribute), r"\s+"), lambda w: w != "")
        held = F.array_contains(words, value) if word else F.array_join(words, " ") == value if attribute == "class" else _attribute(e, attribute) == value
        return (e["name"] == name) & F.coalesce(held, F.lit(False))

    return F.filter(found, fits)


def _first_inside(outer: Column, found: Column) -> Column:
    return F.get(F.filter(found, lambda e: (e["at"] >= outer["begin"]) & (e["at"] < outer["stop"])), F.lit(0))


def _numeric(c: Column) -> Column:
    """&#233; and &#xe9; as characters; numbers that are none become the replacement character."""

    def decoded(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^([0-9]{1,8}|[xX][0-9a-fA-F]{1,7});", 1)
        code = F.when(digits.rlike("^[xX]"), F.conv(F.substring(digits, 2, 8), 16, 10)).otherwise(digits).cast("bigint")
        fits = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(fits, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.concat(char, F.substring(part, F.length(digits) + 2, F.length(part)))

    parts = F.split(c, r"&#(?=(?:[0-9]{1,8}|[xX][0-9a-fA-F]{1,7});)")
    whole = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")
    return F.when(F.contains(c, F.lit("&#")), whole).otherwise(c)


def unescape(c: Column) -> Column:
    c = _numeric(c)
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def page_product_links(pages: DataFrame, host: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page, position, link) of the product cards: the host followed by the href of the first product anchor inside the card, if it has one."""
    found = pages.select(key, elements(F.col(html), ("div", "a")).alias("__e"))
    both = found.select(key, _named(F.col("__e"), "div", *CARD_MARK).alias("__cards"), _named(F.col("__e"), "a", "class", LINK_CLASS, word=True).alias("__anchors"))
    hrefs = F.transform("__cards", lambda card: _attribute(_first_inside(card, F.col("__anchors")), "href"))
    return both.select(key, F.posexplode(hrefs).alias("position", "href")).select(key, "position", F.concat(F.lit(host), "href").alias("link")).where("link IS NOT NULL")


def page_image_cards(pages: DataFrame, host: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page, position, image link, description): nth card's first image beside the text of the first paragraph in the nth card title that has one."""
    found = pages.select(key, F.col(html).alias("__html"), elements(F.col(html), ("div", "img", "a", "p")).alias("__e"))
    parts = found.select(
        key,
        "__html",
        _named(F.col("__e"), "div", "class", IMAGE_CARD_CLASSES).alias("__cards"),
        _named(F.col("__e"), "img", "class", IMAGE_CLASS, word=True).alias("__images"),
        _named(F.col("__e"), "a", "class", TITLE_CLASSES).alias("__titles"),
        F.filter("__e", lambda e: e["name"] == "p").alias("__paragraphs"),
    )
    images = F.transform("__cards", lambda card: text.absolute_url(_attribute(_first_inside(card, F.col("__images")), "src"), host))
    paragraphs = F.filter(F.transform("__titles", lambda title: _first_inside(title, F.col("__paragraphs"))), lambda p: p.isNotNull())

    def content(p: Column) -> Column:
        held = F.substring("__html", p["begin"] + 1, p["stop"] - p["begin"])
        return text.strip(unescape(F.regexp_replace(F.regexp_replace(held, _INERT, ""), "<[^>]*>", "")))

    both = parts.select(key, images.alias("image_link"), F.transform(paragraphs, content).alias("description"))
    zipped = both.select(key, F.posexplode(F.arrays_zip("image_link", "description")).alias("position", "card"))
    return zipped.select(key, "position", "card.image_link", "card.description")


cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
