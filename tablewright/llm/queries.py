"""One registered query per operator, over its whole table."""

from __future__ import annotations

from tablewright.llm import (  # noqa: F401
    op1_query, op2_query, op3_query, op4_query, op5_query, op6_query, op7_query, op8_query, op9_query, op10_query,
    op11_query, op12_query, op13_query,
)
from tablewright.llm.shared import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
