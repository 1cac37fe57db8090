"""Registered queries, each next to the SQL that must give the same rows."""

from tallyspark.plans.queries import cleaning, incremental, landing, marts, quality, star, statistics  # noqa: F401
from tallyspark.plans.queries.base import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
