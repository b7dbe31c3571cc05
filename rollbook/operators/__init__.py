"""Reusable DataFrame operators (DataFrame in, DataFrame out)."""

from rollbook.operators.dims import current_rows, latest_per_key, semi  # noqa: F401
from rollbook.operators.grid import entity_grid, expand_date_range, override_time  # noqa: F401
from rollbook.operators.intervals import (  # noqa: F401
    hull_intervals, islands, merge_intervals, presence_ratio,
)
from rollbook.operators.joins import (  # noqa: F401
    any_key_match, fallback_join, substring_join, week_join,
)
from rollbook.operators.rollup import (  # noqa: F401
    attach_zero, pivot_form, regional_rollup, weighted_avg_or_avg,
)
from rollbook.operators.status import (  # noqa: F401
    overall_status, phase_bucket, placement_rate, retention_rate, row_status, run_rate,
)
from rollbook.operators.weeks import (  # noqa: F401
    sentinel_week_order, upcoming_scaffold, week_label, week_spine,
)
