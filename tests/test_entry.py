"""The registry stands without the text subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
LOOK = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
q, s = e.queries(), e.oracle_sql()
assert len(q) > 300 and set(s) <= set(q), (len(q), set(s) - set(q))
assert not [n for n in q if n.startswith("op") or n == "pipeline"], "text queries without their package"
from wattframe.session import session
spark = session("local[2]", 2, **{"spark.ui.enabled": "false"})
assert q["agg_01_by_keys"](spark, sys.argv[2]).count() > 0
assert e.entry(spark).columns
spark.stop()
print("stands")
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("pipeline_too", [True, False])
def test_stands_without_text_operators(tmp_path, pipeline_too):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for part in ("wattframe/llm", "tests/llm"):
        shutil.rmtree(copy / part, ignore_errors=True)
    if pipeline_too and (copy / "corpus_pipeline.py").exists():
        os.remove(copy / "corpus_pipeline.py")
    out = subprocess.run([sys.executable, "-c", LOOK, str(copy), SF], capture_output=True, text=True, cwd=tmp_path, timeout=300)
    assert out.returncode == 0 and "stands" in out.stdout, out.stderr[-2000:]
