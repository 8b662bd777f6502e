"""The entry module with and without its optional part."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _keys(hide: str) -> set[str]:
    code = f"""
import sys, importlib.abc
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {hide!r} or name == {hide!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
print(*sorted(e.queries()))
"""
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=REPO, capture_output=True, text=True, check=True)
    return set(done.stdout.split())


def test_warehouse_queries_load_without_the_optional_part():
    from __spark_entry__ import QUERIES

    for hide in ("corpus_pipeline", "dimforge.llm", "regex", "sentencepiece"):
        assert _keys(hide) >= set(QUERIES), hide


def test_a_fault_in_the_warehouse_is_not_swallowed():
    for hide in ("dimforge.plans.facts", "pyspark"):
        try:
            _keys(hide)
        except subprocess.CalledProcessError:
            continue
        raise AssertionError(hide)
