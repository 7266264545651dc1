"""All named queries of the engine and their SQL."""

from __future__ import annotations

from . import queries_state  # noqa: F401  adds its queries
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
