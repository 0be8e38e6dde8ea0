"""The driver contract of __spark_entry__.py."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_module
from ledgerlens.plans.oracle import ORACLE_SQL
from ledgerlens.plans.registry import QUERIES
from ledgerlens.plans.reports import SUMMARY_COLUMNS


def test_contract(spark):
    q, o = entry_module.queries(), entry_module.oracle_sql()
    # the library's own queries; those of parts that may be absent come on top
    assert len(QUERIES) == 60 and set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(q) and set(ORACLE_SQL) <= set(o) <= set(q)
    df = entry_module.entry(spark)
    assert df.columns == SUMMARY_COLUMNS
    assert df.count() > 0


REPO = os.path.dirname(os.path.abspath(entry_module.__file__))
ALONE = """
import __spark_entry__ as e
from ledgerlens.session import build_session
assert len(e.queries()) == 60 and set(e.queries()) == set(e.oracle_sql()), len(e.queries())
print(e.entry(build_session("local[2]", shuffle_partitions=2)).count())
"""


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_the_rest_works_without_the_training_data_operators(tmp_path, pipeline_stays):
    """A copy of the repository whose llm folders are gone: the entry imports,
    the flagship query runs and all other tests can be collected."""
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", ".pytest_cache",
                                                              *([] if pipeline_stays else ["corpus_pipeline.py"])))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    ran = subprocess.run([sys.executable, "-c", ALONE], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0 and int(ran.stdout.split()[-1]) > 0, ran.stderr[-2000:]
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, env=env,
                           capture_output=True, text=True, timeout=300)
    assert found.returncode == 0, found.stdout[-2000:]
