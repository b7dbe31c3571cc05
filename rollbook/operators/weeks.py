"""Programme week spine, week labels and the upcoming-weeks scaffold."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.dates import format_week_range, week_start, weeks_between
from rollbook.operators.skew import ROWS_PER_TASK, salted_join

# Fixed values that must equal the reference's.
PRE_PROGRAM = "pre-program start"
UPCOMING = "upcoming lesson"


def week_spine(programs: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """``key, week_start_date (Monday), week_end_date (Sunday), week_number (1-based)``.

    ``GENERATE_ARRAY(0, n)`` with ``n`` whole weeks between the Mondays of
    start and end; a programme ending before it starts (``n < 0``) or with a
    NULL bound gets no weeks.
    """
    n = weeks_between(F.col(end), F.col(start))
    arr = F.when(n >= 0, F.sequence(F.lit(0).cast("long"), n))
    base = week_start(F.col(start))
    return programs.select(F.col(key), base.alias("__w0"), F.explode(arr).alias("__n")).select(
        F.col(key),
        F.date_add(F.col("__w0"), (F.col("__n") * 7).cast("int")).alias("week_start_date"),
        F.date_add(F.col("__w0"), (F.col("__n") * 7 + 6).cast("int")).alias("week_end_date"),
        (F.col("__n") + 1).alias("week_number"))


def week_label(date_col: Column, program_start: Column, week_number: Column,
               week_start_col: Column, week_end_col: Column) -> tuple[Column, Column]:
    """(week_number text, week_range): 'pre-program start' before the first
    Monday, else the number and 'Mon dd - Mon dd' (NULL after the last week)."""
    pre = F.to_date(date_col) < week_start(program_start)
    number = F.when(pre, F.lit(PRE_PROGRAM)).otherwise(week_number.cast("string"))
    rng = F.when(pre, F.lit(PRE_PROGRAM)).otherwise(format_week_range(week_start_col, week_end_col))
    return number, rng


def upcoming_scaffold(participants: DataFrame, spine: DataFrame, on: str, as_of: Column,
                      person_cols: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per participant per week starting after ``as_of``; large programmes are dealt to several tasks."""
    j = salted_join(participants, spine.filter(F.col("week_start_date") > as_of), [on], rows_per_task=rows_per_task)
    return j.select(F.col(on), *[F.col(c) for c in person_cols if c != on],
                    F.col("week_number").cast("string").alias("week_number"),
                    format_week_range("week_start_date", "week_end_date").alias("week_range"))


def sentinel_week_order(week_number: Column) -> Column:
    """Presentation sort key: 'pre-program start' -> 0, else the number (NULL if text)."""
    return F.when(week_number == PRE_PROGRAM, F.lit(0).cast("long")) \
        .otherwise(week_number.try_cast("long"))
