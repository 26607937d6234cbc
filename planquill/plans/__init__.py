"""Registered queries, and plans as rows."""


def all_queries() -> tuple[dict, dict]:
    """(queries, SQL) of the workload and of the plan-log operators."""
    from . import planlog, workload  # noqa: F401
    from .registry import QUERIES, SQL

    return QUERIES, SQL
