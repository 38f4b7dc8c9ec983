"""The entry file without the training-data part, or something it needs."""

import subprocess
import sys

import pytest

HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {hidden!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Hidden())
sys.path.insert(0, ".")
import __spark_entry__ as E
names = set(E.queries())
assert not any(n[:2] == "op" and n[2:3].isdigit() or n == "pipeline" for n in names), names
assert "rolling_7" in names and set(E.oracle_sql()) <= names
"""


@pytest.mark.parametrize("hidden", ["newslake.llm", "corpus_pipeline", "xxhash", "sentencepiece"])
def test_other_queries_work_without_it(hidden):
    code = HIDE.format(hidden=hidden)
    if hidden in ("xxhash", "sentencepiece"):
        code = code.replace("assert not any", "assert True or not any")        # only if the part needs it at import
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
