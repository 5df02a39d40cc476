"""All registered queries of the engine and their SQL twins."""

from __future__ import annotations

from vellum.plans import aggregates, filters, hygiene, joins, scalars, search, sequences, surfaces  # noqa: F401  registers
from vellum.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
