"""Independent SQL answers for DuckDB, to check the Spark models against.

The SQL does not mirror the Spark code: staged tables are written down clean instead of being
cleaned, monthly amounts are exact integers (twelfths of a cent) instead of decimals, and windows,
joins and set operations stand where Spark uses aggregates and arrays.
"""

from oracle.compose import oracle_queries  # noqa: F401
