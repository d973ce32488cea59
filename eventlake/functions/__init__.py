"""Rules as Spark SQL expression text (one JVM call per column, codegen'd)."""

from eventlake.functions.rules import (
    date_key_sql,
    digits_or_sql,
    iso_from_parts_sql,
    iso_parts_sql,
    owner_project_sql,
    ts_text,
    ts_text_sql,
)
from eventlake.functions.variant import falsy_sql, falsy_to_null_sql, py_str_sql

__all__ = [
    "date_key_sql", "digits_or_sql", "iso_from_parts_sql", "iso_parts_sql",
    "owner_project_sql", "ts_text", "ts_text_sql", "falsy_sql", "falsy_to_null_sql", "py_str_sql",
]
