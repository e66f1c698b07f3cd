"""The registry without the document operators: their package, or a module they need, may be missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
PROGRAM = """
import sys, warnings
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Missing())
warnings.simplefilter("ignore")
import __spark_entry__ as entry
print(len(entry._QUERIES), len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["cohortline.llm", "corpus_pipeline", "ahocorasick", "public_tokenizers"])
def test_queries_remain_when_a_module_is_missing(name):
    run = subprocess.run([sys.executable, "-c", PROGRAM.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=True)
    own, registered, oracles = map(int, run.stdout.split())
    assert own >= 50 and registered == own and oracles >= 50
