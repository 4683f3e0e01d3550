"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import dates

# fixed values: product groups that are no goods
NON_GOODS_GROUPS = ("รายได้อื่น ๆ", "ทรัพย์สินอื่น ๆ", "บริการค่าซ่อม,ค่าติดตั้ง", "หนี้สิน")


def doc_prefix(col: str | Column) -> Column:
    return F.substring(F.trim(F.col(col) if isinstance(col, str) else col), 1, 2)


def doc_prefix_filter(df: DataFrame, col: str, prefixes: Sequence[str]) -> DataFrame:
    """Documents whose number has one of the two-letter prefixes and something after it."""
    return df.where(doc_prefix(col).isin(*prefixes) & (F.length(F.trim(col)) > 2))


def date_range_filter(df: DataFrame, col: str, start: dt.date, end: dt.date) -> DataFrame:
    return df.where(F.col(col).between(F.lit(start), F.lit(end)))


def previous_months_filter(df: DataFrame, col: str, run_date: dt.date, n: int) -> DataFrame:
    """Dates in the n calendar months before the run month. (Year, month) are matched as pairs."""
    months = [y * 12 + m - 1 for y, m in dates.previous_n_calendar_months(run_date, n)]
    return df.where(dates.month_key(F.col(col)).isin(*months))


def year_month_filter(df: DataFrame, col: str, years: Iterable[int], months: Iterable[int]) -> DataFrame:
    return df.where(F.year(col).isin(*years) & F.month(col).isin(*months))


def excluded_group_filter(df: DataFrame, col: str, excluded: Sequence[str] = NON_GOODS_GROUPS) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*excluded))


def status_filter(df: DataFrame, sku: str = "stkcod", status: str = "status", wanted: str = "A") -> DataFrame:
    return df.where((F.trim(sku) != "") & (F.trim(status) == wanted))


def operation_filter(df: DataFrame, prefix: str, start: dt.date, end: dt.date) -> DataFrame:
    """Lines of one document kind with operation 1 in the date range."""
    kept = doc_prefix_filter(df, "docnum", [prefix]).where(F.trim("posopr") == "1")
    return date_range_filter(kept, "docdat", start, end)


# Record predicates as (field, operator, value); combine them with all_of / any_of, or write them in prefix form.
Term = tuple[str, str, object]


def term(t: Term) -> Column:
    """'=', '!=', '<', '<=', '>', '>=', 'in', 'ilike' (contains, any case), 'like' (contains), the last three also with 'not', 'set' (id present or absent)."""
    field, op, value = t
    c = F.col(field)
    if op.startswith("not "):
        return ~F.coalesce(term((field, op[4:], value)), F.lit(False))
    if op == "=":
        return c.isNull() if value is None else c == F.lit(value)
    if op == "!=":
        return c.isNotNull() if value is None else (c.isNull() | (c != F.lit(value)))
    if op in ("<", "<=", ">", ">="):
        return {"<": c < F.lit(value), "<=": c <= F.lit(value), ">": c > F.lit(value), ">=": c >= F.lit(value)}[op]
    if op == "in":
        return c.isin(*value)
    if op == "ilike":
        return F.contains(F.lower(c), F.lit(str(value).lower()))
    if op == "like":
        return F.contains(c, F.lit(str(value)))
    if op == "set":
        return c.isNotNull() if value else c.isNull()
    raise ValueError(f"unknown operator {op!r}")


def domain(form: Sequence[str | Term | Sequence]) -> Column:
    """Prefix form of record predicates: '|' and '&' before two conditions, '!' before one, and whatever stands side by side holds together.

    Read from the end with a stack of conditions; the empty form keeps every row.
    """
    stack: list[Column] = []
    for part in reversed(form):
        if not isinstance(part, str):
            stack.append(term(tuple(part)))
            continue
        needed = {"|": 2, "&": 2, "!": 1}.get(part)
        if needed is None:
            raise ValueError(f"unknown connective {part!r}")
        if len(stack) < needed:
            raise ValueError(f"{part!r} needs {needed} conditions behind it")
        first = stack.pop()
        if part == "!":
            stack.append(~F.coalesce(first, F.lit(False)))
        else:
            stack.append(any_of(first, stack.pop()) if part == "|" else all_of(first, stack.pop()))
    return all_of(*reversed(stack)) if stack else F.lit(True)


def all_of(*parts: Term | Column) -> Column:
    out = None
    for p in parts:
        c = p if isinstance(p, Column) else term(p)
        out = c if out is None else out & c
    return out


def any_of(*parts: Term | Column) -> Column:
    out = None
    for p in parts:
        c = p if isinstance(p, Column) else term(p)
        out = c if out is None else out | c
    return out


def domain_filter(df: DataFrame, condition: Term | Column | list) -> DataFrame:
    """condition: a column, one term, or a list in prefix form."""
    if isinstance(condition, list):
        return df.where(domain(condition))
    return df.where(condition if isinstance(condition, Column) else term(condition))
