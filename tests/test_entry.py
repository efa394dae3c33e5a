"""The entry points, with the training-data operators and without them."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry_points

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OPTIONAL = ("tiffinlens/llm", "tests/llm", "corpus_pipeline.py")


def test_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    assert "month" in entry_points.entry(spark).columns


def test_the_rest_stands_alone(tmp_path):
    """Without the optional subpackage everything else imports, and registers what is its own."""
    left_out = [os.path.join(HERE, name) for name in OPTIONAL]

    def absent(folder, names):
        return [n for n in names if os.path.join(folder, n) in left_out or n in (".git", "__pycache__", ".pytest_cache")]

    shutil.copytree(HERE, tmp_path / "repo", ignore=absent)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') for n in q), set(q) == set(e.oracle_sql()))"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    told = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path / "repo", env=environment, capture_output=True, text=True, check=True
    )
    count, added, same = told.stdout.split()
    assert int(count) > 70 and added == "0" and same == "True"
