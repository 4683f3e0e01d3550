"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, the median counts),
BENCH_QUERIES (names separated by commas, or 'all').
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "product_stock_header", "movement_summary", "latest_issue", "earliest_receipt", "zero_price_sku_summary", "stock_by_location",
    "credit_semi_join", "credit_prefix_semi_join", "credit_suffix_match", "invoice_credit_netting", "credit_allocation",
    "invoice_cost_status", "bill_due_date", "remark_consolidate", "line_row_order", "cost_enrich", "sale_area_longest_prefix",
    "invoice_ledger", "ol_sl_ledger", "dealer_invoices", "customer_credit_profile", "cash_ledger", "ledger_upsert", "replace_date_range",
    "price_surface_lookup", "contains_lookup", "order_staging_lines", "report_1a2", "report_3c", "report_5b9", "dbf_scan", "report_csv_scan",
    "text_match_key", "page_product_links", "fabric_product_load",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from ledgerloom.plans import QUERIES
    from ledgerloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()  # the session's own start is not charged to a query; no query is warmed up
    times = {}
    for name in names:
        taken = []
        for _ in range(runs):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        times[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
