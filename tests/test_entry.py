"""The entry module where the corpus subpackage, or what it needs, is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

from workloads.queries import QUERIES

REPOSITORY = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.modules[sys.argv[1]] = None
import __spark_entry__ as entry
print(*entry.queries())
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


@pytest.mark.parametrize("missing", ["martflow.llm", "zstandard", "tiktoken", "xxhash", "public_tokenizers", "corpus_pipeline"])
def test_the_other_queries_stay(missing):
    done = subprocess.run(
        [sys.executable, "-B", "-c", SCRIPT, missing], cwd=REPOSITORY, capture_output=True, text=True, check=True
    )
    assert set(QUERIES) <= set(done.stdout.split())
