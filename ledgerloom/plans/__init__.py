"""End-to-end jobs and the registered queries over the driver tables."""

from ledgerloom.plans import q_cash, q_catalog, q_columns, q_ledger, q_reports, q_sources, q_stock  # noqa: F401
from ledgerloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
