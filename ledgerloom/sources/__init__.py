"""Scans: fixed-width ledger files, line-oriented dumps, JSON snapshots, feeds, sheets, JDBC tables."""
