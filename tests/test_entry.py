import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_oracle_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_the_training_data_operators(tmp_path):
    """The rest of the library works when that subpackage and its pipeline are gone."""
    import shutil

    for name in ("routeloom", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / name)
    shutil.rmtree(tmp_path / "routeloom" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
