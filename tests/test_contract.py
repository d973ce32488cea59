"""Every registered query against its DuckDB oracle on sf0.001, the way the
driver's correctness gate compares them (row count, columns, value hash)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from eventlake.plans.catalog import QUERIES
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry(spark):
    assert E.entry(spark).count() >= 0


def test_entry_works_without_the_training_data_folders(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/eventlake", tmp_path / "eventlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as E; print(sorted(E.queries()) == sorted(E.oracle_sql()), 'pipeline' in E.queries())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["True", "False"], out.stderr


def test_entry_works_without_a_library_of_the_training_data_operators(tmp_path):
    """The warehouse's queries stay where an import of the operators fails."""
    import subprocess
    import sys

    (tmp_path / "xxhash.py").write_text("raise ModuleNotFoundError('hidden', name='xxhash')")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as E; q = E.queries(); print(len(q) == len(E.QUERIES) == len(E.oracle_sql()), 'pipeline' in q)"
    env = {**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["True", "False"], out.stderr
