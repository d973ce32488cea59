"""Scalar rules of the conformed view, as Spark SQL expression text.

Each ``*_sql`` function takes SQL text for its input and returns SQL text;
the Column-returning wrappers are for callers that compose DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake import schema as S
from eventlake.functions.sqltext import lit

# An id must be ASCII digits only. \A and \z anchor the whole
# string; Java's `$` would also accept a trailing newline.
DIGITS = r"\A[0-9]+\z"

# Shapes accepted by Python's datetime.fromisoformat (3.10) once every "Z" has
# been replaced by "+00:00": a date, then optionally any one separator
# character and HH[:MM[:SS[.fff[fff]]]] with an optional +HH:MM offset.
_ISO_SHAPE = (
    r"\A(\d{4})-(\d{2})-(\d{2})"
    r"(?:[^\n](\d{2})(?::(\d{2})(?::(\d{2})(?:\.(\d{3}(?:\d{3})?))?)?)?"
    r"([+-]\d{2}:\d{2})?)?\z"
)
_ISO_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"


def digits_or_sql(text: str, default: str) -> str:
    """BIGINT of a digit string, else ``default`` (FN-3, FN-4).

    A digit string too long for BIGINT also gives the default: it passes the
    regex but would make a strict cast fail the whole job.
    """
    d = f"CAST({default} AS BIGINT)"
    return (f"CASE WHEN {text} RLIKE {lit(DIGITS)} "
            f"THEN COALESCE(TRY_CAST({text} AS BIGINT), {d}) ELSE {d} END")


def iso_parts_sql(text: str) -> str:
    """Components of an ISO-8601 string, or NULL if its shape is not one
    Python's ``datetime.fromisoformat`` (3.10) accepts after replacing every
    ``Z`` by ``+00:00``: ``[date, HH, MM, SS, fraction, offset]`` with ``''``
    for absent parts. One regex replace and one split, no per-group scans.
    """
    s = f"replace({text}, 'Z', '+00:00')"
    return (f"CASE WHEN {s} RLIKE {lit(_ISO_SHAPE)} THEN split(regexp_replace({s}, "
            f"{lit(_ISO_SHAPE)}, '$1-$2-$3|$4|$5|$6|$7|$8'), {lit(chr(92) + '|')}) END")


def iso_from_parts_sql(parts: str) -> str:
    """Timestamp from ``iso_parts_sql``; out-of-range values give NULL and a
    missing offset is read as UTC (FN-17)."""
    p = lambda i, d: f"coalesce(nullif({parts}[{i}], ''), '{d}')"
    canonical = (f"concat({parts}[0], ' ', {p(1, '00')}, ':', {p(2, '00')}, ':', {p(3, '00')}, "
                 f"'.', rpad({parts}[4], 6, '0'), {p(5, '+00:00')})")
    return f"try_to_timestamp({canonical}, '{_ISO_FORMAT}')"


def date_key_sql(ts: str) -> str:
    """Smart date key yyyymmdd as INT (FN-9), in the session time zone."""
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INT)"


def owner_project_sql(name: str) -> tuple[str, str]:
    """Owner and project of a repository name (FN-10..12).

    A name that a slash cuts into exactly two pieces is ``owner/project``,
    either of which may be empty; any other name gives the sentinels.
    """
    pieces = f"split({name}, '/', -1)"
    return tuple(f"coalesce(if(size({pieces}) = 2, {pieces}[{i}], NULL), '{unknown}')"
                 for i, unknown in enumerate((S.UNKNOWN_REPO_OWNER, S.UNKNOWN_REPO_PROJECT)))


def ts_text_sql(ts: str) -> str:
    return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')"


def ts_text(ts: Column) -> Column:
    """Timestamp rendered as ``yyyy-MM-dd HH:mm:ss`` text (for reports)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
