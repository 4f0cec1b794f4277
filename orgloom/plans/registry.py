"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import compiler, graph, identity, inference, knowledge, landing, links, lookups, nested, records, retrieval, staging

MODULES = (graph, links, identity, inference, knowledge, compiler, staging, lookups, nested, records, retrieval, landing)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES: dict[str, str] = {k: s for m in MODULES for k, s in m.ORACLES.items()}
FLAGSHIP = "repo_contribution"
