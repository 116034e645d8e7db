"""The contract holds without the training-data folder."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as contract
names = contract.queries()
assert "analyze_feedback" in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert set(contract.oracle_sql()) <= set(names)
"""


@pytest.mark.parametrize("name", ["feedback_loom.llm", "corpus_pipeline"])
def test_other_queries_stay_without_the_training_data_folder(name):
    done = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_training_data_folder():
    for path in (ROOT / "feedback_loom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path


def test_every_query_has_a_name_of_its_own_and_sql_names_queries():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
