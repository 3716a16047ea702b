"""Registered queries, one module per part of the inventory."""

from . import aggregates, features, models, plans, rows, storage  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
