"""Operators of a training-data pipeline over crawled pages and documents.

Nothing else in the library imports this subpackage. ``queries()`` holds one
query per operator over the given tables, ``oracle_sql()`` the SQL for those
that SQL can express.
"""

from tablepipe.llm.plans import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
