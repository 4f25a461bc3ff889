"""All registered queries."""

from tablewright.plans import (  # noqa: F401
    aggregates, changes, discovery, joining, masks, predicates, scalars, scans, streams,
)
from tablewright.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
