"""Views of the given tables as log tables, and the registered queries over them."""

from .catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
