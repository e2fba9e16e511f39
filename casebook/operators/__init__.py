"""DataFrame operators shared by the analyses.

Each operator is a composition of built-in DataFrame operations.  The ones
that replace a per-key window are written so that a hot key (one customer
or user holding a large share of all rows) never sends its raw rows to one
task: rows are first aggregated to a grain whose size per key is bounded by
the calendar (day, 12-hour bucket), the window runs on that grain, and the
result is joined back on a key that is unique on the aggregated side (which
adaptive skew-join handling can split).
"""

from casebook.operators.calendar import fill_months  # noqa: F401
from casebook.operators.distinct import (  # noqa: F401
    bitmaps, count_bitmaps, count_sketches, sketches,
)
from casebook.operators.ranking import (  # noqa: F401
    first_ranked, join_back, keep_extreme, rank_by, rows_at_max, top_k,
)
from casebook.operators.sequence import next_date_in_order  # noqa: F401
from casebook.operators.sessions import sessionize  # noqa: F401
from casebook.operators.running import running_total_by_day  # noqa: F401
from casebook.operators.compare import (  # noqa: F401
    merge_spellings, period_sum, unpivot_dims,
)
from casebook.operators.joins import (  # noqa: F401
    dyadic_nodes, interval_join, membership_flag, not_in_values,
)
from casebook.operators.strings import ordered_string_agg  # noqa: F401
