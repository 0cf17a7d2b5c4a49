"""Every operator as a named query over the given tables."""

from cohortloom.catalog import (  # noqa: F401
    attach, conform, models, reports, scans, streams, summarise,
)
from cohortloom.catalog.base import BUILDERS, ORACLES, QUERIES

__all__ = ["BUILDERS", "ORACLES", "QUERIES"]
