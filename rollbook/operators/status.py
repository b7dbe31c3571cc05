"""Status labels, programme phase and rate formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.safe import safe_divide, safe_int

# Fixed values that must equal the reference's (labels, in precedence order).
EXEMPTED, EXCUSED, ATTENDED, ABSENT = "exempted", "excused", "attended", "absent"
BREAK, WAIVED = "break", "waived"
UNDER_HALF = "attended (attendance percentage under 50%)"
ONGOING = "Ongoing"
PHASE_0_6 = "0-6 MO. SINCE GRADUATION"
PHASE_7_12 = "7-12 MO. SINCE GRADUATION"
PHASE_13_18 = "13-18 MO. SINCE GRADUATION"
CONCLUDED = "Concluded"


def row_status(exempt: Column, excused: Column, attended: Column) -> Column:
    """Row-level status: exempted > excused > attended > absent.

    The labels sort in that same order as strings, so ``max(row_status)``
    over a group keeps the highest-precedence one (the reference's MAX).
    """
    return (F.when(exempt, F.lit(EXEMPTED))
            .when(excused, F.lit(EXCUSED))
            .when(attended, F.lit(ATTENDED))
            .otherwise(F.lit(ABSENT)))


def overall_status(title: Column, is_exempt: Column, excused: Column, waived: Column,
                   week_status: Column, pct: Column) -> Column:
    """break -> exempted -> excused -> waived -> attended -> under 50% -> absent."""
    return (F.when(F.lower(title).like("%break%"), F.lit(BREAK))
            .when(is_exempt, F.lit(EXEMPTED))
            .when(excused, F.lit(EXCUSED))
            .when(waived, F.lit(WAIVED))
            .when(week_status == ATTENDED, F.lit(ATTENDED))
            .when(pct < 0.5, F.lit(UNDER_HALF))
            .otherwise(F.lit(ABSENT)))


def phase_bucket(months: Column) -> Column:
    """Programme phase from the months-since-completion text.

    'Ongoing' stays; 0-6, 7-12, 13-18 months get bands; 19+ is 'Concluded';
    anything else (negative, non-numeric, NULL) falls through as the raw text.
    """
    m = safe_int(months)
    return (F.when(months == ONGOING, F.lit(ONGOING))
            .when(m.between(0, 6), F.lit(PHASE_0_6))
            .when(m.between(7, 12), F.lit(PHASE_7_12))
            .when(m.between(13, 18), F.lit(PHASE_13_18))
            .when(m >= 19, F.lit(CONCLUDED))
            .otherwise(months))


def placement_rate(placed: Column, enrolled: Column) -> Column:
    return safe_divide(placed, F.nullif(enrolled, F.lit(0)))


def retention_rate(enrolled: Column, admitted: Column) -> Column:
    return safe_divide(enrolled, F.nullif(admitted, F.lit(0)))


def run_rate(placed: Column, enrolled: Column, months: Column) -> Column:
    """placed / (enrolled x months); NULL when 'Ongoing' or 0 months; an
    unparsable month count counts as 1."""
    m = safe_int(months)
    den = F.coalesce(enrolled, F.lit(0)) * F.coalesce(m, F.lit(1))
    return (F.when(months == ONGOING, F.lit(None).cast("double"))
            .when(m == 0, F.lit(None).cast("double"))
            .otherwise(safe_divide(placed, F.nullif(den, F.lit(0)))))
