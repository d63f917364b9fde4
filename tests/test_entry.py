import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", [("slotstream.llm",), ("slotstream.llm", "corpus_pipeline")])
def test_entry_without_the_optional_folders(gone):
    """Also where the module of the pipeline is still there."""
    code = f"gone = {gone!r}" + """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in gone:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert 'block_stats' in e.queries() and 'pipeline' not in e.queries() and not any(k.startswith('op') for k in e.oracle_sql())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
