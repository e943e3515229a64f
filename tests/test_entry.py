"""The contract module when the training-data subpackage cannot be imported."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("blocked", ["regex", "public_tokenizers", "tokenizers", "foliograph.llm", "corpus_pipeline"])
def test_other_queries_stay(blocked):
    code = f"""
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {blocked!r} or name.startswith({blocked + "."!r}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
from foliograph.checks.queries import QUERIES
assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
