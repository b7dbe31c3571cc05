"""Writers: clustered table write and the day-partitioned snapshot merge."""

from rollbook.sinks.snapshot import (  # noqa: F401
    FullRefreshNotAllowed, evolve_table_schema, should_snapshot, snapshot_exists, snapshot_merge,
    write_clustered,
)
