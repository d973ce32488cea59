"""REJ-1: route every raw line either to bronze or to the dead-letter table.

Rows are classified with one column expression instead of per-row exception
handling, so the split is a pair of filters over the same parsed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventlake import schema as S
from eventlake.functions.sqltext import lit
from eventlake.functions.variant import get_sql, py_str_sql

# A JSON \\u0000 escape that is not itself escaped (preceded by an even run of
# backslashes), or a raw NUL character.
_OBJECT = r"\A[ \t\r\n]*\{"
_NUL = r"(?:^|[^\\])(?:\\\\)*\\u0000|\x00"
#: A string after the line, by which the parser shows that it read all of the line.
_END = "~eventlake end of line~"


def reject_reason_sql(text: str, kind: str, id_text: str) -> str:
    """First failing rule, or NULL for a line that belongs in bronze.

    ``kind`` is ``''`` for a line that is not one whole JSON value, else
    ``object`` or ``other``; ``id_text`` is the JSON text of its ``id`` member.
    """
    return (
        f"CASE WHEN {kind} = '' THEN '{S.REJECT_NOT_JSON}' "
        f"WHEN {kind} <> 'object' THEN '{S.REJECT_NOT_OBJECT}' "
        f"WHEN {id_text} IS NULL OR {id_text} = 'null' THEN '{S.REJECT_MISSING_ID}' "
        f"WHEN substring({id_text}, 1, 1) = '{{' THEN '{S.REJECT_INVALID_ID}' "
        f"WHEN (contains({text}, {lit(chr(92) + 'u0000')}) OR contains({text}, char(0))) AND {text} RLIKE {lit(_NUL)} THEN '{S.REJECT_NUL}' END"
    )


def classify(raw: DataFrame, text_col: str = "value") -> DataFrame:
    """Add ``full_json``, ``event_id``, ``event_type`` and ``reject_reason``
    (NULL for accepted rows).

    Spark's JSON readers stop after the first value, so a line alone does not
    show what follows it. A line is parsed once, as an array of it and a mark:
    if the mark comes out as the second of two elements, the line is one value
    and nothing else. The mark must not be spelled in the line itself, for which
    its characters or a \\u escape would be needed.

    Other lines are parsed in two ways. As the element of an array, text after
    the value breaks the array or makes a second element; as the member of an
    object, what closes the array early breaks the object. A line that is exactly
    one element in the one and parses in the other is one value and nothing else.

    ``event_id`` is the event's key in every layer: the ``str()`` of the id.
    """
    t = f"`{text_col}`"
    items = lambda text: f"try_variant_get(try_parse_json({text}), '$', 'array<variant>')"
    alone, ended = f"concat('[', {t}, ']')", f"concat('[', {t}, ',\"{_END}\"]')"
    marked = raw.selectExpr(
        "*",
        f"CASE WHEN NOT contains({t}, '{_END}') AND NOT contains({t}, {lit(chr(92) + 'u')}) THEN {items(ended)} END AS __marked")
    once = marked.selectExpr(
        "*", f"CASE WHEN size(__marked) = 2 AND {get_sql('__marked[1]', '$', 'string')} = '{_END}' THEN __marked[0] END AS __once")
    parsed = once.selectExpr("*", f"CASE WHEN __once IS NULL THEN {items(alone)} END AS __items")
    member = f"try_parse_json(concat('{{\"x\":', {t}, '}}')) IS NOT NULL"
    whole = parsed.selectExpr("*", f"coalesce(__once, CASE WHEN size(__items) = 1 AND {member} THEN __items[0] END) AS full_json")
    staged = whole.selectExpr(
        "*",
        f"CASE WHEN full_json IS NULL THEN '' WHEN substring({t}, 1, 1) = '{{' OR {t} RLIKE {lit(_OBJECT)} THEN 'object' ELSE 'other' END AS __kind",
        f"{get_sql('full_json', '$.id')} AS __id",
        f"{get_sql('full_json', '$.type', 'string')} AS event_type",
    ).selectExpr("*", "to_json(__id) AS __id_text")
    staged = staged.selectExpr("*", f"{py_str_sql('__id', '__id_text')} AS event_id")
    cols = [c for c in staged.columns if not c.startswith("__")]
    return staged.selectExpr(
        *[f"`{c}`" for c in cols],
        f"{reject_reason_sql(t, '__kind', '__id_text')} AS reject_reason")
