"""The registry where packages of the text operators are missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, {root!r})
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.partition(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(k.startswith("op") for k in e.queries()))
"""


@pytest.mark.parametrize("name", ["xxhash", "zstandard", "hourgrid.llm", "corpus_pipeline"])
def test_other_queries_do_not_need_packages_of_the_text_operators(name):
    done = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, name=name)], capture_output=True, text=True, timeout=120)
    n, m, text = done.stdout.split() if done.stdout else pytest.fail(done.stderr)
    assert int(n) > 100 and int(m) > 100 and text == "False"


def test_a_missing_module_of_the_library_itself_is_an_error():
    done = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, name="hourgrid.session")], capture_output=True, text=True, timeout=120)
    assert "ModuleNotFoundError" in done.stderr and not done.stdout
