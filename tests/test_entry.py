"""The entry module without a package that only the text operators need."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
sys.modules["sentencepiece"] = None
import __spark_entry__ as entry
from seasonflow import catalog
assert set(entry.queries()) == set(catalog.QUERIES), sorted(entry.queries())
assert set(entry.oracle_sql()) == set(catalog.SQL)
"""


def test_other_queries_stay_when_a_text_package_is_absent():
    done = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "text queries are left out" in done.stderr
