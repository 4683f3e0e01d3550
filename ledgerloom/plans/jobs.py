"""Jobs: the operators composed into the reports and tables the back office refreshes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom import session
from ledgerloom.functions import numbers, text
from ledgerloom.operators import filters, ledger, matching, ordered, refresh
from ledgerloom.schemas import CREDIT_DETAIL, CREDIT_HEADER, INVOICE_DETAIL, INVOICE_HEADER, conform

_HEADER_NAMES = {
    "docnum": "doc_number",
    "docdat": "doc_date",
    "sonum": "so_number",
    "cuscod": "customer_code",
    "disc": "discount",
    "remamt": "remamount",
    "docstat": "doc_stat",
}
_DETAIL_NAMES = {"docnum": "doc_number", "docdat": "doc_date", "unitpr": "unit_price", "disc": "discount"}


class Tables(Mapping[str, DataFrame]):
    """A job's tables by name. Each is built when it is asked for, once."""

    def __init__(self, **makers: Callable[[], DataFrame]):
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


# A job's documents are worked on in slices, one after another: what a slice shuffles and keeps for itself is gone before the next one begins.
SLICES = 2
SLICE_ROWS = 4_000_000


def slice_count(rows: DataFrame) -> int:
    return min(SLICES, max(1, -(-rows.count() // SLICE_ROWS)))


def sliced(rows: DataFrame, key: Column, many: int) -> Iterator[DataFrame]:
    """rows in `many` parts by the key's hash; rows of a key (null too) share one."""
    for i in range(many):
        yield rows.where(F.pmod(F.xxhash64(key), F.lit(many)) == i) if many > 1 else rows


def _allocated_details(
    invoice_lines: DataFrame,
    credit_lines: DataFrame,
    products: DataFrame,
    bounds: ordered.Bounds,
    match_description: bool = False,
    price_mode: str = "zero",
) -> DataFrame:
    """Invoice lines with cost and what credit notes of the same base number, SKU (and description) and price took off."""
    base = ledger.base_number("docnum")
    if match_description:
        key = text.text_match_key(base, F.col("stkcod"), F.col("stkdes"))
    else:
        key = F.concat(base, F.lit("|"), F.col("stkcod"))
    keyed = [
        part.withColumn("__key", key)
        .withColumn("unitpr", numbers.unit_price_fallback(F.col("unitpr"), F.col("trnval"), price_mode))
        .withColumn("trnqty", numbers.numeric_or_zero(F.col("trnqty")))
        for part in (invoice_lines, credit_lines)
    ]
    allocated = ledger.credit_allocation(keyed[0], keyed[1], ["__key"], "unitpr", bounds.order, bounds_from=bounds)
    return ledger.cost_enrich(allocated.drop("__key"), products)


class _Details:
    """Lines of a job's invoices and credit notes. What several of its tables read is made once, and only if one of them is asked for.

    All that is done with a line stays among the lines of its base number, so the lines are worked on in slices of base numbers.
    """

    def __init__(
        self, lines: DataFrame, invoices: DataFrame, credits: DataFrame, products: DataFrame, order: Sequence[str], price_mode: str, match_description: bool,
        invoice_prefixes: Sequence[str], credit_prefixes: Sequence[str],
    ):
        self.lines, self.invoices, self.credits, self.products, self.order = lines, invoices, credits, products, order
        self.price_mode, self.match_description = price_mode, match_description
        self.prefixes = invoice_prefixes, credit_prefixes

    @cached_property
    def split(self) -> list[tuple[DataFrame, DataFrame]]:
        """(lines of the invoices, lines of the credit notes) by slice."""
        many = slice_count(self.lines)
        # numbers are written once, as every slice reads them
        docs = [session.materialise(d.select("docnum").distinct(), "numbers") for d in (self.invoices, self.credits)]
        base = ledger.base_number("docnum")
        return [self._split(*parts) for parts in zip(*(sliced(d, base, many) for d in (self.lines, *docs)), strict=True)]

    def _split(self, lines: DataFrame, invoices: DataFrame, credits: DataFrame) -> tuple[DataFrame, DataFrame]:
        # a line with another prefix has no document of the kind, so it need not be dealt out to find none
        first, second = (lines.where(filters.doc_prefix("docnum").isin(*p)) for p in self.prefixes)
        return ledger.detail_split(first, invoices, credits)[0], ledger.detail_split(second, invoices, credits)[1]

    @cached_property
    def costs(self) -> DataFrame:
        """The products that lines name: mostly few, so that lines meet them without a shuffle."""
        return session.materialise(self.products.join(self.lines.select("stkcod").distinct(), "stkcod", "left_semi").select("stkcod", "unitpr"), "costs")

    @cached_property
    def order_bounds(self) -> ordered.Bounds:
        return ordered.quantile_bounds(self.lines, self.order)

    @cached_property
    def bounds(self) -> ordered.Bounds:
        return ordered.quantile_bounds(self.lines, ["seqnum", *self.order])

    def _allocated(self, columns: Sequence[str]) -> Iterator[DataFrame]:
        """Allocated lines with cost by slice, with as many columns of the lines as asked for; a slice's own tables go with it."""
        spark = self.lines.sparkSession
        for invoice_lines, credit_lines in self.split:
            with session.tracked() as passing:
                # read by block and by line
                kept = session.materialise(invoice_lines.select(*columns), "lines")
            yield _allocated_details(kept, credit_lines, self.costs, self.order_bounds, self.match_description, self.price_mode)
            session.drop_tables(spark, passing)

    @cached_property
    def detail(self) -> DataFrame:
        def numbered() -> Iterator[DataFrame]:
            for allocated in self._allocated(self.lines.columns):
                with session.tracked() as passing:
                    written = session.materialise(allocated, "details")
                yield self._numbered(written, INVOICE_DETAIL)
                session.drop_tables(written.sparkSession, passing)

        return session.materialise_all(numbered(), "detail")

    @cached_property
    def balances(self) -> DataFrame:
        """What the status needs of the lines."""
        used = {"docnum", "stkcod", "stkdes" if self.match_description else "stkcod", "unitpr", "trnval", "trnqty", *self.order}
        allocated = self._allocated([c for c in self.lines.columns if c in used])
        return session.materialise_all((a.select(F.col("docnum").alias("doc_number"), "stkcod", "cost", "qty_balance") for a in allocated), "balances")

    def _numbered(self, lines: DataFrame, schema: T.StructType) -> DataFrame:
        numbered = ledger.line_row_order(lines, ["docnum", "stkcod"], self.bounds.order, bounds_from=self.bounds)
        return conform(numbered.withColumnsRenamed(_DETAIL_NAMES), schema)

    def status(self, headers: DataFrame, white_list: DataFrame) -> DataFrame:
        lines = self.detail if "detail" in self.__dict__ else self.balances
        return conform(ledger.invoice_cost_status(headers, lines, white_list), INVOICE_HEADER)

    def of_invoices(self) -> DataFrame:
        return self.detail

    def of_credits(self) -> DataFrame:
        """Lines of the credit notes with price, cost and row order."""
        lines = self._split(self.lines, self.invoices, self.credits)[1]
        priced = lines.withColumn("unitpr", numbers.unit_price_fallback(F.col("unitpr"), F.col("trnval"), self.price_mode))
        priced = priced.withColumn("trnqty", numbers.numeric_or_zero(F.col("trnqty")))
        return self._numbered(ledger.cost_enrich(priced, self.products), CREDIT_DETAIL)


def invoice_ledger(
    docs: DataFrame,
    remarks: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    areas: DataFrame,
    products: DataFrame,
    white_list: DataFrame,
    start: dt.date,
    end: dt.date,
    line_order: Sequence[str],
) -> Tables:
    """Header, remark, detail, credit and credit_detail tables of the invoices IV/OL/CM in the date range.

    Invoices and credits are read by several tables, so each is written once to the shared folder, allocated lines too
    when a table needs them. A header has its whole remark, `remark` has it in parts; merged_headers puts the headers into the target.
    """
    invoices, credits = ledger.ledger_documents(docs, start, end)
    invoices = ledger.customer_enrich(ledger.dedupe_first(invoices, "docnum", ["line_no"]), customers)
    invoices = session.materialise(invoices, "invoices")
    credits = session.materialise(ledger.credit_semi_join(credits, invoices), "credits")
    details = _Details(lines, invoices, credits, products, line_order, "zero", False, ledger.INVOICE_PREFIXES, ledger.CREDIT_PREFIXES)

    @cache
    def texts() -> DataFrame:
        def consolidated() -> Iterator[DataFrame]:
            many = slice_count(remarks)
            for some, docs in zip(*(sliced(d, F.col("docnum"), many) for d in (remarks, invoices.select("docnum"))), strict=True):
                with session.tracked() as passing:
                    # consolidating reads its input several times
                    kept = session.materialise(some.join(docs, "docnum", "left_semi"), "remarks")
                yield ledger.remark_consolidate(kept)
                session.drop_tables(kept.sparkSession, passing)

        return session.materialise_all(consolidated(), "texts")

    def header() -> DataFrame:
        headers = ledger.remark_enrich(invoices.drop("sonum"), texts(), whole=True).withColumnsRenamed(_HEADER_NAMES)
        keyed = invoices.drop("sonum").withColumnsRenamed(_HEADER_NAMES)
        dated = ledger.bill_due_date(matching.sale_area_longest_prefix(keyed, areas), bills_from=keyed)
        headers = headers.drop("duedat").join(dated.select("doc_number", "duedat", "sale_area_code"), "doc_number")
        return details.status(headers, white_list)

    return Tables(
        header=header,
        remark=lambda: texts().where("remark IS NOT NULL").select(F.col("docnum").alias("doc_number"), "part_no", "remark"),
        detail=details.of_invoices,
        credit=lambda: conform(ledger.customer_enrich(credits, customers).withColumnsRenamed(_HEADER_NAMES), CREDIT_HEADER),
        credit_detail=details.of_credits,
    )


def merged_headers(target: DataFrame, loaded: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The target's headers after a load: the range is purged, the loaded headers are inserted or update the ones that stand outside it, and
    due dates follow from all documents of a bill, loaded now or before."""
    kept = refresh.replace_date_range(target, loaded.limit(0), "doc_date", start, end)
    return ledger.bill_due_date(refresh.ledger_upsert(kept, loaded))


def ol_sl_ledger(
    docs: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    white_list: DataFrame,
    years: Sequence[int],
    months: Sequence[int],
    line_order: Sequence[str],
    invoice_prefix: str = "OL",
    credit_prefixes: Sequence[str] = ("SL",),
    credit_rule: str = "prefix",
) -> Tables:
    """Full refresh of one document pair.

    credit_rule 'prefix': credits are matched by number (OL001 -> SL001-A); 'order': by the invoice number without its prefix in their
    order number. A line without a price takes its line value as the price.
    """
    prefix = F.substring(F.trim("docnum"), 1, 2)
    invoices = docs.where((prefix == invoice_prefix) & F.year("docdat").isin(*years) & F.month("docdat").isin(*months))
    invoices = invoices.withColumn("disc", numbers.document_discount(F.col("amount"), F.col("total")))
    credits = docs.where(prefix.isin(*credit_prefixes))
    if credit_rule == "order":
        bases = invoices.select(ledger.after_prefix("docnum").alias("__base"))
        credits = credits.join(bases, F.col("sonum") == F.col("__base"), "left_semi")
    elif credit_rule == "prefix":
        credits = ledger.credit_prefix_semi_join(credits, invoices)
    else:
        raise ValueError(f"unknown credit rule {credit_rule!r}")
    group = ledger.customer_group_rule(F.col("customer_code"), F.col("customer_name"))
    # this ledger also wants the same description on both lines
    details = _Details(lines, invoices, credits, products, line_order, "value", True, [invoice_prefix], credit_prefixes)

    def named(documents: DataFrame) -> DataFrame:
        return ledger.customer_enrich(documents, customers).withColumnsRenamed(_HEADER_NAMES).withColumn("customer_group", group)

    return Tables(
        header=lambda: details.status(named(invoices), white_list),
        detail=details.of_invoices,
        credit=lambda: conform(named(credits), CREDIT_HEADER),
        credit_detail=details.of_credits,
    )


def dealer_invoices(docs: DataFrame, customers: DataFrame, target: DataFrame, start: dt.date, end: dt.date) -> Tables:
    """Netted invoices not yet in the target with all their credit numbers, the same numbers in parts (references), and their credit entries."""
    invoices, credits = ledger.dealer_documents(docs, start, end)

    def unknown(rows: DataFrame) -> DataFrame:
        return rows.join(target.select("doc_number").distinct(), "doc_number", "left_anti").select(*rows.columns)

    def invoice() -> DataFrame:
        names = customers.select("cuscod", F.col("cusnam").alias("customer_name"))
        netted = ledger.invoice_credit_netting(invoices, credits, whole=True).join(names, "cuscod", "left")
        return unknown(
            netted.select(
                F.col("docnum").alias("doc_number"),
                F.col("docdat").alias("doc_date"),
                F.col("cuscod").alias("customer_code"),
                "customer_name",
                "amount",
                F.col("disc").alias("discount"),
                "total",
                "net_total",
                "debit_note_refs",
            )
        )

    return Tables(
        invoice=invoice,
        references=lambda: unknown(ledger.credit_references(invoices, credits).withColumnRenamed("docnum", "doc_number")),
        credit=lambda: ledger.credit_suffix_match(invoices, credits),
    )


def exchange_rate_load(rates: DataFrame) -> DataFrame:
    """Feed rows -> rate records of the target system."""
    return rates.select(
        F.col("period").alias("name"),
        numbers.currency_id_map(F.col("currency_id")).alias("currency_id"),
        F.col("selling").try_cast("decimal(15,4)").alias("inverse_company_rate"),
    )
