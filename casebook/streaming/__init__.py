"""Streaming forms of the analyses."""

from casebook.streaming.allocation import (  # noqa: F401
    allocation_rows, monthly_allocation, running_balance_stream,
)
from casebook.streaming.corrections import STATE_STORE, corrected_balance_stream, latest  # noqa: F401
from casebook.streaming.sessions import visit_summary_stream  # noqa: F401,E402
