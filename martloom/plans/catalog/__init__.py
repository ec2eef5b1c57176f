"""Registered queries, each with the SQL that must give the same rows."""

from martloom.plans.catalog import checks, columns, loads, marts  # noqa: F401
from martloom.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
