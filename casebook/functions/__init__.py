"""Column functions: native expressions for the dialect rules."""

from casebook.functions.dates import (  # noqa: F401
    days_between, month_name, parse_dmy2, us_week, us_week_of_dmy2, weekday_name,
    year_month,
)
from casebook.functions.arith import (  # noqa: F401
    ci_eq, int_avg, int_div, pct_change, ratio, signed_amount,
)
