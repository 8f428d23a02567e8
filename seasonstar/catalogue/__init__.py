"""The operators applied to the star-schema test tables, and the same queries as plain SQL."""

from seasonstar.catalogue import landed, scalars, tables, timeseries  # noqa: F401  (registers the queries)
from seasonstar.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
