"""Scans: lake tables, bounded logs, and the test-data adapters (fixtures)."""

from candlewick.sources.tables import table, trades_for_day, trades_for_days, log_batch  # noqa: F401
