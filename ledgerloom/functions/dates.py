"""Dates. The run date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def date_or_null(c: Column, fmt: str = "yyyyMMdd") -> Column:
    return F.try_to_date(c, fmt)


def trailing_months_range(run_date: dt.date, months: int) -> tuple[dt.date, dt.date]:
    """First day of the month `months` months back, and the run date."""
    index = run_date.year * 12 + run_date.month - 1 - months
    return dt.date(index // 12, index % 12 + 1, 1), run_date


def previous_n_calendar_months(run_date: dt.date, n: int) -> list[tuple[int, int]]:
    """(year, month) pairs before the run month, newest first."""
    index = run_date.year * 12 + run_date.month - 1
    return [((index - i) // 12, (index - i) % 12 + 1) for i in range(1, n + 1)]


def months_before(run_date: dt.date, months: int) -> dt.date:
    """Same day `months` earlier, clipped to the month's last day."""
    index = run_date.year * 12 + run_date.month - 1 - months
    year, month = index // 12, index % 12 + 1
    last = (dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month, min(run_date.day, last))


def month_key(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c) - 1


# fixed values: abbreviated Thai month names, January first
THAI_MONTHS = (
    "ม.ค.", "ก.พ.", "มี.ค.", "เม.ย.", "พ.ค.", "มิ.ย.", "ก.ค.", "ส.ค.", "ก.ย.", "ต.ค.", "พ.ย.", "ธ.ค.",
)
BUDDHIST_ERA = 543


def thai_date_to_iso(c: Column) -> Column:
    """'28 พ.ค. 2567' -> 2024-05-28; null where the text is no such date."""
    parts = F.split(c, " ")
    names = F.array(*[F.lit(m) for m in THAI_MONTHS])
    month = F.nullif(F.array_position(names, F.get(parts, F.lit(1))), F.lit(0))
    year = F.get(parts, F.lit(2)).try_cast("int") - BUDDHIST_ERA
    day = F.get(parts, F.lit(0)).try_cast("int")
    iso = F.format_string("%04d-%02d-%02d", year, month, day)
    ok = year.isNotNull() & month.isNotNull() & day.isNotNull() & (F.size(parts) == 3)
    return F.when(ok, F.try_to_date(iso, "yyyy-MM-dd"))


def iso_to_thai_date(c: Column) -> Column:
    names = F.array(*[F.lit(m) for m in THAI_MONTHS])
    return F.concat_ws(
        " ", F.dayofmonth(c).cast("string"), F.element_at(names, F.month(c)), (F.year(c) + BUDDHIST_ERA).cast("string")
    )


def local_to_utc(c: Column, hours: int = 7) -> Column:
    """dd/MM/yyyy HH:mm:ss local text -> UTC wall-clock timestamp without zone."""
    local = F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm:ss")).cast("timestamp_ntz")
    return local - F.expr(f"INTERVAL {hours} HOURS")


def delivery_date(c: Column) -> Column:
    return F.try_to_date(c, "dd/MM/yyyy")


def payment_date_rule(trndat: Column, payindat: Column, docdat: Column, rule: str = "transaction") -> Column:
    """'transaction': the bank date (current); 'first_known': pay-in, else bank, else document date (earlier)."""
    if rule == "transaction":
        return trndat
    if rule == "first_known":
        return F.coalesce(payindat, trndat, docdat)
    raise ValueError(f"unknown rule {rule!r}")
