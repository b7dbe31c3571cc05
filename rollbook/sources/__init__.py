"""Table access: a name -> location registry and the driver's parquet tables."""

from rollbook.sources.tables import DRIVER_TABLES, TableRegistry, read_table  # noqa: F401
