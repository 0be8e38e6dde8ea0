"""Workers need no copy of the package: the session is started outside of the
repository, and what tasks run comes with them."""

import os
import subprocess
import sys

import pytest

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import tempfile
from ledgerlens.session import build_session, checkpoint_dir
spark = build_session("local[2]", shuffle_partitions=2)
checkpoint_dir(spark, tempfile.mkdtemp(dir={folder!r}))
from pyspark.sql import functions as F

def found(_):
    import importlib.util
    yield importlib.util.find_spec("ledgerlens") is not None

assert spark.sparkContext.parallelize([0], 1).mapPartitions(found).collect() == [False]
from ledgerlens.llm.queries import QUERIES
print(QUERIES[{name!r}](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("name", ["op1_html_main_text", "op9_crf_langid", "op11_token_alignment", "op12_merkle_manifest",
                                  "op13_token_files"])
def test_query_without_the_package_on_the_workers(tmp_path, name):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    ran = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, folder=str(tmp_path), name=name)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0 and int(ran.stdout.split()[-1]) > 0, ran.stderr[-1500:]
