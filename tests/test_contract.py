"""The driver's contract with and without the optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] in {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
names = set(e.queries())
assert {{'publish_swap', 'rpt_query_history'}} <= names and set(e.oracle_sql()) <= names
assert not any(n.startswith('op') and n[2].isdigit() for n in names) and 'pipeline' not in names
print(len(names))
"""


@pytest.mark.parametrize("hidden", [("llm", "corpus_pipeline"), ("xxhash",), ("public_tokenizers",)])
def test_the_mart_answers_without_the_optional_part(hidden):
    """The package may be gone, and a library that only it needs may be missing."""
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden, root=ROOT)], capture_output=True, text=True, cwd="/tmp")
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[-1]) >= 92
    there = os.path.isdir(os.path.join(ROOT, "llm"))
    assert ("is left out" in done.stderr) == (there and hidden[0] != "llm")
