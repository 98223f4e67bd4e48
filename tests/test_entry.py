"""The entry module without the training-data operators."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, {repo!r})
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {gone!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as E
names = set(E.queries())
assert "range_table" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(E.oracle_sql()) <= names
"""


@pytest.mark.parametrize("gone", [["salesguard.llm"], ["corpus_pipeline"], ["corpus_pipeline", "salesguard.llm"]])
def test_other_queries_stay(gone):
    subprocess.run([sys.executable, "-c", CODE.format(repo=REPO, gone=gone)], check=True, timeout=120)


@pytest.mark.parametrize("library", ["xxhash", "tiktoken", "sentencepiece", "public_tokenizers"])
def test_a_missing_library_of_theirs_leaves_the_others(library):
    """Whether the operators need it at import or only in tasks."""
    code = CODE.format(repo=REPO, gone=[library]).replace(
        'assert "range_table" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names',
        'assert "range_table" in names')
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], check=True, timeout=120)


def test_what_is_left_out_is_said():
    code = CODE.format(repo=REPO, gone=["xxhash"]).replace("import __spark_entry__ as E", """
import warnings
import __spark_entry__ as E
warnings.simplefilter("error")
try:
    E.queries()
except UserWarning as e:
    assert "xxhash" in str(e)
    warnings.simplefilter("ignore")
else:
    sys.exit("silent")
""")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
