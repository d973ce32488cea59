"""Helpers to write rules as Spark SQL expression text.

A rule written as SQL text reaches the JVM in one call (``F.expr`` /
``selectExpr``) instead of one call per function node, which keeps driver
time per job small for wide, many-branch projections.
"""

from __future__ import annotations


def lit(value: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
