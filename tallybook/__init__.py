"""tallybook — invoicing, settlement and ledger-export reports on Spark DataFrames.

Layout
------
sources/    reading the invoice model (parquet tables) and the test-table lift
functions/  Column -> Column helpers: money rounding, valuation rules, text, dates
operators/  reusable DataFrame operators: skew-safe joins, either-key join,
            id-list explode, text aggregation, group totals
plans/      the business chains and the three reports built from them
"""

from tallybook.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
