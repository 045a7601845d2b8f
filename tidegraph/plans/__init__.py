"""The registered queries over the star-schema and event tables, and the SQL that must give the same rows."""

from .queries import QUERIES
from .sql import SQL

__all__ = ["QUERIES", "SQL"]
