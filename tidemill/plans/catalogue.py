"""Loads all query modules; importing it fills the registry."""

from __future__ import annotations

from tidemill.plans import asking, corpus, learning, sessions, statistics, tables, timeline  # noqa: F401
from tidemill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
