"""Column-level helpers (built-in Spark expressions only, no Python UDFs)."""

from rollbook.functions.dates import (  # noqa: F401
    day_name, format_month, format_week_range, is_friday, is_month_end, local_date,
    month_start, parse_month, week_start, weeks_between,
)
from rollbook.functions.json import json_bool, json_query, json_scalar  # noqa: F401
from rollbook.functions.safe import safe_divide, safe_int, seconds_between  # noqa: F401
from rollbook.functions.text import normalize_email, staff_email_pattern  # noqa: F401
