"""The entry points without the training-data subpackage, or without a library of it."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("absent", ["forecourt.llm", "xxhash", "regex", "corpus_pipeline"])
def test_other_queries_stay(absent):
    code = f"""
import sys
sys.modules[{absent!r}] = None
import __spark_entry__ as entry
from forecourt import registry
assert set(entry.queries()) >= set(registry.queries()) and set(entry.oracle_sql()) >= set(registry.oracle_sql())
assert "v_sal_6_dealership_performance" in entry.queries()
print(len(entry.queries()) - len(registry.queries()))
"""
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    if absent != "regex":  # imported where it is used only
        assert done.stdout.strip() == "0"
