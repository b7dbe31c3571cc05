"""Text predicates: staff/test e-mail exclusion and e-mail normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Fixed values that must equal the reference's: the staff / test account pattern,
# matched unanchored against the lower-cased address.
STAFF_EMAIL_PATTERN = r"@company\.com\b|\bcompany\b.*\btest\b|\btest\b.*\bcompany\b|\+test\d*@|@internal\.com\b"


def staff_email_pattern(staff_domain: str = "company.com", company_word: str = "company",
                        internal_domain: str = "internal.com") -> str:
    """The exclusion pattern with another organisation's domains and name.

    With the defaults it is exactly ``STAFF_EMAIL_PATTERN``.
    """
    sd, cw, idm = (re.escape(staff_domain), re.escape(company_word), re.escape(internal_domain))
    return (rf"@{sd}\b|\b{cw}\b.*\btest\b|\btest\b.*\b{cw}\b|\+test\d*@|@{idm}\b")


def normalize_email(col) -> Column:
    """``LOWER(TRIM(email))``."""
    return F.lower(F.trim(_c(col)))


def is_staff_email(col, pattern: str | None = None) -> Column:
    """True when the lower-cased address matches the exclusion pattern (NULL stays NULL)."""
    return F.lower(_c(col)).rlike(pattern or STAFF_EMAIL_PATTERN)
