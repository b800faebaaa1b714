import pytest

from quillon.queries import QUERIES, SQL

from .compare import duckdb_rows, rows_of


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert rows_of(QUERIES[name](spark, sf_dir)) == duckdb_rows(SQL[name], sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 200


def test_entry_without_the_training_text_folders(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{here}/quillon", tmp_path / "quillon", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{here}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'review_plan_200' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
