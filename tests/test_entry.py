"""The entry points when the corpus operators, or a library that only they use, are missing."""

from __future__ import annotations

import subprocess
import sys

import pytest


@pytest.mark.parametrize("missing", ["ahocorasick", "regex", "tidewatch.llm", "corpus_pipeline"])
def test_entry_without_a_module(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
from tidewatch.registry import QUERIES, SQL
assert entry.queries() == QUERIES and entry.oracle_sql() == SQL and len(QUERIES) > 70
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
