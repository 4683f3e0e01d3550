"""Numbers, prices and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerloom.schemas import MONEY


def numeric_or_zero(c: Column, dtype=MONEY) -> Column:
    """Text that is no number counts as 0; a number that does not fit the type is an error, not 0."""
    wide = T.DecimalType(38, dtype.scale)
    return F.coalesce(c.try_cast(wide), F.lit(0).cast(wide)).cast(dtype)


def document_discount(amount: Column, total: Column) -> Column:
    return (amount - total).cast(MONEY)


def unit_price_fallback(unit_price: Column, line_value: Column, mode: str = "zero") -> Column:
    """mode 'zero': missing price -> 0 (current rule); 'value': 0 or missing -> the line value (earlier rule)."""
    price = F.coalesce(unit_price, F.lit(0).cast(MONEY))
    if mode == "zero":
        return price
    if mode == "value":
        return F.when(price == 0, F.coalesce(line_value, F.lit(0).cast(MONEY))).otherwise(price)
    raise ValueError(f"unknown mode {mode!r}")


def area_price(width: Column, height: Column, price: Column) -> dict[str, Column]:
    """Curtain area pricing: quantity is 1.2 x area, areas below 1 pay the difference up to 1.2."""
    area = width * height
    quantity = area * F.lit(1.2)
    return {
        "area": area,
        "quantity": quantity,
        "addon": F.when(area < 1, (F.lit(1.2) - quantity) * price),
        "value": price,
    }


# fixed values: currency ids of the target system
CURRENCY_IDS = {"USD": 2, "CNY": 7, "MYR": 34}


def currency_id_map(c: Column) -> Column:
    out = F.lit(None).cast("int")
    for code, number in CURRENCY_IDS.items():
        out = F.when(c == code, F.lit(number)).otherwise(out)
    return out


def bank_flow_type(c: Column) -> Column:
    return F.when(c == "BT", F.lit("out")).when(c.startswith("B"), F.lit("in"))


# fixed values: labels printed for an invoice and its payment
_PAYMENT_LABELS = {
    "not_paid": "Not Paid",
    "in_payment": "In Payment",
    "paid": "Paid",
    "partial": "Partially Paid",
    "reversed": "Reversed",
    "invoicing_legacy": "Invoicing App Legacy",
}
_STATE_LABELS = {"draft": "Draft.", "cancel": "Cancel."}


def payment_state_label(state: Column, payment_state: Column) -> Column:
    out = F.lit(None).cast("string")
    for key, label in _PAYMENT_LABELS.items():
        out = F.when((state == "posted") & (payment_state == key), F.lit(label)).otherwise(out)
    for key, label in _STATE_LABELS.items():
        out = F.when(state == key, F.lit(label)).otherwise(out)
    return out


def round_half_even(c: Column, digits: int = 2) -> Column:
    return F.bround(c, digits)


def settlement_note(amount: Column, settled: Column, template: tuple[str, str]) -> Column:
    """template[0] amount template[1] settled, '' when settled is '-'. Empty cells print as nan."""
    text = F.concat(
        F.lit(template[0]), F.coalesce(amount, F.lit("nan")), F.lit(template[1]), F.coalesce(settled, F.lit("nan"))
    )
    return F.when(settled == "-", F.lit("")).otherwise(text)
