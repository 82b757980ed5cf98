"""All registered queries."""

from stockloom.catalog.registry import QUERIES, full_sql, run  # noqa: F401
from stockloom.catalog import kpis, loads, operations, planning, relational, reports, scalars, sources  # noqa: F401
