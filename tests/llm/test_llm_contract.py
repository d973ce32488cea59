"""Registered operator queries on sf0.001: against their SQL where there is
one, and every contract's columns and row counts."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from eventlake.llm.queries import ORACLE_SQL, QUERIES
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_urls": "page_id host path rule verdict",
    "op2_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op4_mixing": "doc_id size source_size target taken",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_tokens": "doc_id start n_tokens ids_crc32",
    "op8_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op9_extract": "page_id url text n_chars",
    "op10_warc": "file pos page_id offset length digest replica_digest replica_torn",
    "op11_variants": "word form root n n_near form_n",
    "op12_counts": "doc_id n_bytes n_tokens over_limit",
    "op13_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}
ROWS = {"op1_urls": "pages", "op9_extract": "pages"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE_SQL) <= set(E.oracle_sql()) and "pipeline" not in E.oracle_sql()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_rows_and_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert set(COLUMNS[name].split()) <= set(df.columns)
    if name not in ("op3_chat", "op10_warc", "op11_variants", "op13_repair"):
        table = ROWS.get(name, "documents")
        assert len(rows) == con.execute(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    if name in ORACLE_SQL:
        answer = con.execute(ORACLE_SQL[name])
        columns = [d[0] for d in answer.description]
        want = answer.fetchall()
        assert sorted(columns) == sorted(df.columns)
        assert (len(rows), digest(df.columns, rows)) == (len(want), digest(columns, want))
