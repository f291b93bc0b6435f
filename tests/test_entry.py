"""The core's queries work where the optional subpackage, or something that it needs, is missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
from importlib.abc import MetaPathFinder
class Missing(MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError("No module named " + name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
from headway.plans import queries as core
assert set(e.queries()) == set(core.QUERIES), set(e.queries()) ^ set(core.QUERIES)
assert set(e.oracle_sql()) == set(core.ORACLES)
"""


@pytest.mark.parametrize("name", ["headway.llm", "public_tokenizers", "tokenizers_of_another_kind"])
def test_missing_modules(name):
    code = CODE.format(name=name)
    if name.startswith("tokenizers_"):  # nothing is missing
        code = "import __spark_entry__ as e\nassert len(e.queries()) >= 35"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
