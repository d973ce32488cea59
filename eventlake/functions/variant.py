"""Rules over VARIANT values that mirror Python's view of parsed JSON.

They work on the JSON text of a value (``to_json``), computed once per field
as its own column, so a document with many fields stays a handful of small
expressions. All helpers return Spark SQL expression text.
"""

from __future__ import annotations

from eventlake.functions.sqltext import lit

# JSON spellings of Python-falsy values; numeric zero is
# matched by the pattern.
FALSY_JSON = ("null", "false", '""', "{}", "[]")
NUMERIC_ZERO = r"\A-?0+(\.0*)?([eE][+-]?[0-9]+)?\z"


def get_sql(v: str, path: str, type_: str = "variant") -> str:
    """``try_variant_get``: NULL when the path is missing or the cast fails."""
    return f"try_variant_get({v}, {lit(path)}, '{type_}')"


def falsy_sql(text: str) -> str:
    """True when a value, given as its JSON text, is falsy in Python after
    ``json.loads``: missing, null, false, 0, "", {} or []. Never NULL."""
    spellings = ", ".join(lit(s) for s in FALSY_JSON)
    return (f"({text} IS NULL OR {text} IN ({spellings}) "
            f"OR coalesce(substring({text}, 1, 1) IN ('-', '0') AND {text} RLIKE {lit(NUMERIC_ZERO)}, false))")


def py_str_sql(x: str, text: str) -> str:
    """``str()`` of a parsed JSON value: strings unquoted, booleans
    ``True`` / ``False``, numbers and containers in their JSON spelling."""
    return (f"CASE WHEN substring({text}, 1, 1) = '\"' THEN {get_sql(x, '$', 'string')} "
            f"WHEN {text} = 'true' THEN 'True' WHEN {text} = 'false' THEN 'False' "
            f"ELSE {text} END")


def falsy_to_null_sql(x: str, text: str) -> str:
    """``str(x) if x else None``."""
    return f"CASE WHEN NOT {falsy_sql(text)} THEN {py_str_sql(x, text)} END"
