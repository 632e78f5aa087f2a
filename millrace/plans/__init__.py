"""Registered queries of the engine's own operators, with their DuckDB equivalents."""

from __future__ import annotations

from millrace.plans import naming, pages, records, runs, tables

QUERIES = {**naming.QUERIES, **pages.QUERIES, **records.QUERIES, **runs.QUERIES, **tables.QUERIES}
ORACLES = {**naming.ORACLES, **pages.ORACLES, **records.ORACLES, **runs.ORACLES, **tables.ORACLES}
