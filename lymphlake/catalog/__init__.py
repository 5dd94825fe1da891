"""Queries of the repertoire operators and the SQL that must give the same rows."""

from lymphlake.catalog.registry import ORACLES, QUERIES
from lymphlake.catalog import alignment, annotation, cells, clones, profiles, scalars, sources, statistics  # noqa: E402,F401

__all__ = ["ORACLES", "QUERIES"]
