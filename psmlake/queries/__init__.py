"""The library's operators over the driver's tables, and the same in SQL."""

from psmlake.queries import core, features, jobs, quality, relational, text_tables

MODULES = (core, relational, text_tables, features, quality, jobs)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
