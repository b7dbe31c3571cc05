"""NULL-safe arithmetic and casts (``SAFE_DIVIDE``, ``SAFE_CAST``, ``TIMESTAMP_DIFF``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_divide(num, den) -> Column:
    """NULL when the divisor is 0 or NULL; double result."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def safe_int(col) -> Column:
    """``SAFE_CAST(x AS INT64)``: NULL for text such as 'Ongoing' or 'abc'."""
    return _c(col).cast("string").try_cast("long")


def seconds_between(start, end) -> Column:
    """``TIMESTAMP_DIFF(end, start, SECOND)``: whole seconds, truncated toward zero."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))
