"""The driver's entry points where packages for training text are missing."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry

LATE = """
import sys, warnings
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r}:
            raise ModuleNotFoundError("hidden", name=name)
sys.meta_path.insert(0, Hidden())
warnings.simplefilter("ignore")
import __spark_entry__ as e
print(sum(n.startswith("op") for n in e.queries()), len(e.queries()), len(e.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["zstandard", "public_tokenizers", "tiktoken", "corpus_pipeline"])
def test_missing_packages_leave_the_survey_queries(name):
    done = subprocess.run(
        [sys.executable, "-c", LATE.format(name=name)],
        capture_output=True,
        text=True,
        cwd=entry.__file__.rsplit("/", 1)[0],
    )
    assert done.returncode == 0, done.stderr
    text, queries, sql = map(int, done.stdout.split())
    assert text == 0
    assert queries == sql == len(entry.QUERIES)
