"""PRJ-2: bronze envelope (VARIANT) -> the typed silver columns.

The reference does this with a Python function per row; here every rule is a
SQL column expression over the parsed document, so it runs inside
whole-stage codegen and never leaves the JVM. The projection is built in
stages (sub-documents, then their JSON text, then the values) so each piece
is computed once per row and the generated code stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventlake import schema as S
from eventlake.functions.rules import iso_from_parts_sql, iso_parts_sql
from eventlake.functions.variant import falsy_sql, falsy_to_null_sql, get_sql

# Scalar fields: output column -> JSON path. A member of a missing or
# non-object parent (``"actor": "x"``) reads as missing.
SCALARS = {
    "event_id": "$.id",
    "event_type": "$.type",
    "actor_id": "$.actor.id",
    "actor_login": "$.actor.login",
    "repo_id": "$.repo.id",
    "repo_name": "$.repo.name",
    "org_id": "$.org.id",
    "org_login": "$.org.login",
}
SILVER_FIELDS = list(SCALARS) + ["event_time", "is_public", "payload"]


def extract(bronze: DataFrame, json_col: str = "full_json") -> DataFrame:
    """Add the eleven silver columns and ``silver_reject_reason`` to bronze
    rows (bronze columns of the same name are replaced)."""
    keep = [f"`{c}`" for c in bronze.columns
            if c not in SILVER_FIELDS and c != "silver_reject_reason"]
    fields = {**SCALARS, "created_at": "$.created_at", "public": "$.public", "payload": "$.payload"}
    # 1. sub-documents
    s1 = bronze.selectExpr(*keep, *[f"{get_sql(f'`{json_col}`', p)} AS __v_{n}" for n, p in fields.items()])
    # 2. their JSON text
    s2 = s1.selectExpr("*", *[f"to_json(__v_{n}) AS __t_{n}" for n in [*SCALARS, "created_at"]])
    # 3. values
    created = (f"CASE WHEN substring(__t_created_at, 1, 1) = '\"' "
               f"THEN {get_sql('__v_created_at', '$', 'string')} END")
    s3 = s2.selectExpr(
        "*",
        *[f"{falsy_to_null_sql(f'__v_{n}', f'__t_{n}')} AS {n}" for n in SCALARS],
        # falsy created_at ("" / missing) -> NULL; non-strings -> NULL.
        f"{iso_parts_sql(f'nullif({created}, {chr(39)}{chr(39)})')} AS __time_parts",
        # missing -> true; an explicit null stays NULL (the view makes it true).
        f"CASE WHEN __v_public IS NULL THEN true ELSE {get_sql('__v_public', '$', 'boolean')} END AS is_public",
        # missing -> {}; JSON null is kept as a JSON null.
        "coalesce(__v_payload, parse_json('{}')) AS payload",
    )
    s4 = s3.selectExpr("*", f"{iso_from_parts_sql('__time_parts')} AS event_time")
    return s4.selectExpr(*SILVER_FIELDS, f"{silver_reject_reason_sql('__t_event_id')} AS silver_reject_reason",
                         *keep)


def silver_reject_reason_sql(id_text: str) -> str:
    """Why a bronze row cannot become a silver row (NULL when it can).

    A falsy id is skipped by the reference without being marked, which makes
    its batch loop re-read the row for ever; here it is recorded instead.
    Ids and types longer than silver's columns are recorded too, so one bad
    row cannot abort the batch. Names have no limit in silver: a long one is
    kept and counted in the gold run's report.
    """
    limits = S.SILVER_LENGTH_LIMITS
    branches = " ".join(f"WHEN length({n}) > {k} THEN '{S.SILVER_REJECT_TOO_LONG}:{n}'"
                        for n, k in limits.items())
    return f"CASE WHEN {falsy_sql(id_text)} THEN '{S.SILVER_REJECT_FALSY_ID}' {branches} END"
