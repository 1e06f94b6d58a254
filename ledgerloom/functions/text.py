"""Literals as SQL text: one expression string instead of hundreds of Column calls."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal


def literal(value) -> str:
    """SQL text of a setting."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value) + "D"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name(column: str) -> str:
    """Quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def array(values) -> str:
    return "array(" + ", ".join(literal(v) for v in values) + ")"


def one_of(column: str, values) -> str:
    return f"{name(column)} IN (" + ", ".join(literal(v) for v in values) + ")"


def map_of(mapping: dict) -> str:
    return "map(" + ", ".join(f"{literal(k)}, {literal(v)}" for k, v in mapping.items()) + ")"
