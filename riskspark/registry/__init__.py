"""Queries by operator id, with the SQL that gives the same rows."""

from riskspark.registry import core, queries_features, queries_models, queries_tables  # noqa: F401

QUERIES, ORACLES = core.QUERIES, core.ORACLES
