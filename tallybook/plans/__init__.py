"""Registered queries over the given tables."""

from . import allocation, community, facts, files, fusion, graphs, series, text
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
