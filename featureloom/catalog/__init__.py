"""Registered queries with their oracle SQL."""

from . import assembly, buckets, cleaning, graphs, ingest, matrices, modes  # noqa: F401
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
