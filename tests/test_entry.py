"""The entry without the training-data package, or without a library that it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()), sum(k.startswith("op") for k in entry.queries()),
      "pipeline" in entry.queries(), set(entry.oracle_sql()) <= set(entry.queries()))
"""


@pytest.mark.parametrize("missing", ["cohortline.llm", "public_tokenizers", "xxhash"])
def test_other_queries_stay(missing):
    out = subprocess.run([sys.executable, "-c", PROBE.format(missing=missing)], cwd=ROOT,
                         capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) >= 164 and out[1:] == ["0", "False", "True"]
