"""Operators for preparing training data: search, scoring, deduplication, extraction, packing.

Nothing outside this package imports it. The queries over the given tables are in
``ledgerloom.llm.queries``.
"""
