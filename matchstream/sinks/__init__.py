"""Sinks: versioned keyed tables (file), JDBC merge, and streaming hooks."""

from matchstream.sinks.keyed_table import KeyedTable
from matchstream.sinks.jdbc_merge import JdbcKeyedTable

__all__ = ["KeyedTable", "JdbcKeyedTable"]
