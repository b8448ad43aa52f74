"""The entry point with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_llm(tmp_path):
    shutil.copytree(f"{ROOT}/broadloom", tmp_path / "broadloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'flagship' in q and not any(n.startswith('op1_') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_every_sql_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_flagship(spark):
    import __spark_entry__ as e

    if os.path.isdir(e.SMOKE_DIR):
        assert e.entry(spark).count() > 0
