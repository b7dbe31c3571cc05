"""Every operator of the blueprint run over the driver tables, with its DuckDB oracle."""

from rollbook.catalog import attendance, meetings, products, reporting  # noqa: F401  (registration)
from rollbook.catalog.registry import ORACLE_SQL, QUERIES  # noqa: F401
