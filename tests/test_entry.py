"""The entry module without the part for training corpora, or without a module that this part needs."""

import os
import subprocess
import sys

import pytest

from jobtide.queries import ALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("blocked", ["tiktoken", "corpus_pipeline", "jobtide.llm"])
def test_other_queries_stay(blocked):
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", CODE.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, sql = map(int, run.stdout.split())
    assert queries == len(ALL) and sql == sum(q.sql is not None for q in ALL.values())
