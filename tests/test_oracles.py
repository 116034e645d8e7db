"""The SQL side of the contract stands on its own files."""

import subprocess
import sys
from pathlib import Path

import oracles
from feedback_loom.sources import default_stop_words

ROOT = Path(__file__).resolve().parents[1]


def test_stop_words_kept_in_the_repository_equal_the_library_defaults(spark):
    assert oracles.stop_words() == default_stop_words()


def test_oracles_need_no_spark():
    code = "import sys; sys.modules['pyspark'] = None; import oracles; print(len(oracles.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=60)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 79


def test_a_query_evaluates_only_the_parts_it_names(monkeypatch):
    def fail():
        raise AssertionError("not named")

    monkeypatch.setitem(oracles.PARTS, "stop", fail)
    assert oracles.sql("batch_numbers")
