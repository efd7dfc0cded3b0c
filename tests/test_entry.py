"""The entry point without the optional operators, or without a module that they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["tidemark.llm", "corpus_pipeline", "zstandard", "public_tokenizers"])
def test_other_queries_stay_without_the_optional_ones(missing):
    code = f"""
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ModuleNotFoundError("hidden " + name, name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
names = entry.queries()
assert not [n for n in names if n.startswith("op") or n == "pipeline"], sorted(names)
assert set(entry.oracle_sql()) <= set(names) and len(names) > 80
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
