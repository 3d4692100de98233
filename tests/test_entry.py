"""The entry file without its optional parts."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def loaded(without):
    """Number of queries, and whether the training-data ones are among them, with some modules absent."""
    code = (f"import sys; sys.modules.update({{name: None for name in {without!r}}}); sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as e; print(len(e.queries()), e.llm is not None, set(e.oracle_sql()) <= set(e.queries()))")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    return done.stdout.split() if done.returncode == 0 else done.stderr


@pytest.mark.parametrize("without", [["xxhash"], ["zstandard"], ["tokenizers"], ["corpus_pipeline"], ["tallyfold.llm"]])
def test_optional_modules(without):
    count, llm, checked = loaded(without)
    assert int(count) > 75 and (llm, checked) == ("False", "True")


def test_a_part_of_the_core_may_not_be_absent():
    assert "ModuleNotFoundError" in loaded(["tallyfold.operators.panes"])
