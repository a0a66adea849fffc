"""The entry without the training-text operators."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)

BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {blocked!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Blocked())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
names = set(e.queries())
assert len(names) > 100 and set(e.oracle_sql()) <= names
assert "pipeline" not in names
print(sum(n.startswith("op") and n[2].isdigit() for n in names))
"""


def run(*blocked):
    code = BLOCKED.format(blocked=blocked, root=ROOT)
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip()


def test_without_the_subpackage():
    assert run("weftline.llm") == "0"


def test_without_the_pipeline():
    assert run("corpus_pipeline") in ("0", "13")


def test_without_a_library_of_theirs():
    assert run("xxhash") == "0"
