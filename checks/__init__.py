"""Registered queries and their SQL, one module per operator family."""

from checks.registry import ORACLES, QUERIES

from checks import cleaning, configs, files, jobs, landed, lookups, stored, submissions, tables, updates  # noqa: F401, E402

__all__ = ["ORACLES", "QUERIES"]
