"""Text clean-up, codes and match keys, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions import titles

# (?U): Unicode-aware classes, as the inputs carry Thai text and no-break spaces
_EDGE_SPACE = r"(?U)^\s+|\s+$"
_SPACES = r"(?U)\s+"


def strip(c: Column) -> Column:
    """Trim every Unicode white space (F.trim drops plain blanks only)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def blank_to_null(c: Column, blanks: tuple[str, ...] = ("", "~", "None", "nan")) -> Column:
    s = strip(c)
    return F.when(~s.isin(*blanks), s)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _SPACES, " "))


def nbsp_to_space(c: Column) -> Column:
    return F.translate(c, "\u00a0", " ")


def space_to_nbsp(c: Column) -> Column:
    return F.translate(c, " ", "\u00a0")


def control_char_strip(c: Column, keep_tab_newline: bool = False) -> Column:
    """Drop control characters; the spreadsheet variant keeps tab and line feed and the C1 range."""
    pattern = r"[\x00-\x08\x0B-\x1F\x7F]" if keep_tab_newline else r"[\x00-\x1F\x7F-\x9F]"
    return F.regexp_replace(c, pattern, "")


def leading_thai_strip(c: Column) -> Column:
    return F.regexp_replace(c, "^[ก-๙]", "")


def bracket_code(c: Column) -> Column:
    """Text between the first '[' and the next ']' (to the end where none follows); null without '['."""
    tail = F.regexp_extract(c, r"(?s)^[^\[]*\[([^\[\]]*)", 1)
    return F.when(F.contains(c, F.lit("[")), tail)


# fixed values: words taken out of a fabric description
_OPACITY_WORDS = (
    "Black\\s?Out|BlackOut|BLACKt|DIM OUT|Black out|Blackout|Dim Out|BLACKOUT|BlackOut-|Dim out "
)


def fabric_code(c: Column) -> Column:
    """First run of letters, digits, blanks and hyphens without the opacity words; null where none."""
    run = F.nullif(F.regexp_extract(c, r"(?U)([A-Za-z0-9\s\-]+)", 1), F.lit(""))
    return F.regexp_replace(F.regexp_replace(run, f"(?U){_OPACITY_WORDS}", ""), r"(?U)^\s+", "")


def fabric_code_upper(c: Column, plastic: str = "พลาสติก") -> Column:
    """First upper-case word group; '' for plastic items; the text itself where nothing matches."""
    group = r"(?U)\b[A-Z]+ ?[A-Z0-9\-]*\b"
    return (
        F.when(F.contains(c, F.lit(plastic)), F.lit(""))
        .when(c.rlike(group), F.regexp_extract(c, f"({group})".replace("((?U)", "(?U)("), 1))
        .otherwise(c)
    )


def honorific_split(c: Column, prefixes: tuple[str, ...] = titles.HONORIFICS) -> tuple[Column, Column]:
    """(title, rest): longest known title first; title '' and the text unchanged where none fits."""
    longest_first = sorted(set(prefixes), key=lambda p: (-len(p), p))
    pattern = "^(" + "|".join(r"\Q" + p + r"\E" for p in longest_first) + ")"
    title = F.regexp_extract(c, pattern, 1)
    rest = F.when(title == "", c).otherwise(strip(F.substring(c, F.length(title) + 1, F.length(c))))
    return title, rest


def category_path_split(c: Column) -> tuple[Column, Column]:
    """'A / B / C' -> ('A ', 'C'), cut at '/ ' so the first part keeps its trailing blank."""
    parts = F.split(c, "/ ")
    return F.element_at(parts, 1), F.element_at(parts, -1)


def cheque_number_clean(c: Column) -> Column:
    return F.regexp_replace(c, r"^\*", "")


def zero_to_dash(c: Column) -> Column:
    """'-' where the text reads as zero, else the text."""
    return F.when(F.trim(c).try_cast("double") == 0, F.lit("-")).otherwise(c)


def safe_file_name(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\w\-_. ]", "_")


def absolute_url(c: Column, host: str) -> Column:
    return F.when(F.contains(c, F.lit("https")), c).otherwise(F.concat(F.lit(host), c))


def url_product_id(c: Column, prefix: str) -> Column:
    """What is left of a detail link without its prefix and slashes."""
    return F.replace(F.replace(c, F.lit(prefix), F.lit("")), F.lit("/"), F.lit(""))


def nfkc(c: Column) -> Column:
    """Compatibility form, by the Unicode library that comes with Spark. ASCII text is its own form."""
    ascii_only = c.rlike(r"^\p{ASCII}*$")
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(c, F.lit("")), F.lit(True))
    return F.when(c.isNull() | ascii_only, c).otherwise(composed)


def text_match_key(base: Column, sku: Column, description: Column) -> Column:
    """base|sku|description with the description normalised; null when base or sku is null."""
    desc = squeeze(nfkc(F.coalesce(description, F.lit(""))))
    return F.concat(base, F.lit("|"), sku, F.lit("|"), desc)
