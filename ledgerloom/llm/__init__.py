"""Operators for preparing training text; their queries are in ledgerloom.llm.queries."""
