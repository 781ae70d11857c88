"""The driver contract: every engine query is registered, with or without the
training-data subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

WITHOUT = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in {absent}:
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
from larder.plans.registry import QUERIES
assert set(e.queries()) == set(QUERIES), set(e.queries()) ^ set(QUERIES)
assert set(e.oracle_sql()) <= set(e.queries())
"""


def registered_without(*absent):
    done = subprocess.run([sys.executable, "-c", WITHOUT.format(absent=absent)], cwd=ROOT,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_queries_without_the_training_data_package():
    registered_without("larder.llm")


def test_queries_without_the_pipeline_file():
    registered_without("corpus_pipeline")


def test_queries_without_a_library():
    registered_without("xxhash", "pandas.absent")
