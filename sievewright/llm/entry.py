"""What the driver's entry module adds if this subpackage is there."""

from .queries import queries
from .sql import oracle_sql

__all__ = ["oracle_sql", "queries"]
