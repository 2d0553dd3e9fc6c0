"""The entry module without the subpackage of numbered operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_stands_without_the_subpackage(tmp_path, pipeline):
    target = str(tmp_path / "copy")
    os.makedirs(target)
    shutil.copytree(f"{ROOT}/tranche", f"{target}/tranche", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", target)
    if pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", target)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), 'pipeline' in q)"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    found = subprocess.run([sys.executable, "-c", code], cwd=target, env=environment, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    count, known, listed = found.stdout.split()
    assert int(count) > 80 and known == "True" and listed == "False"
