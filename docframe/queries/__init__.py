"""Registered queries of the library and their SQL."""

from docframe.queries import aggregates, filters, groups, scalars, shapes, stores  # noqa: F401
from docframe.queries.registry import ORACLE_SQL, QUERIES  # noqa: F401
